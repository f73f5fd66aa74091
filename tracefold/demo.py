"""Process models for the event and conversation tables."""

_SHOP = (
    ("t1", "signup", ("p1",), ("p3", "p5")),
    ("t2", "view", ("p3",), ("p4",)),
    ("t3", "click", ("p4",), ("p3",)),
    ("t4", "purchase", ("p4", "p5"), ("p2",)),
    ("t5", "error", ("p3",), ("p3",)),
)

# Model id -> (transition id, event name, input places, output places).
# Every model starts with one token in p1.
NETS = {
    "shop": _SHOP,
    "shop_amb": _SHOP + (
        ("t6", "view", ("p3",), ("p6",)),
        ("t7", "purchase", ("p6", "p5"), ("p2",)),
        ("t8", "click", ("p6",), ("p3",)),
    ),
    "shop_noerror": _SHOP[:4],
    "explode": (
        ("t1", "view", ("p1",), ("p1", "p3")),
        ("t2", "view", ("p1",), ("p1", "p4")),
        ("t3", "view", ("p1",), ("p1", "p5")),
        ("t4", "signup", ("p1",), ("p1",)),
        ("t5", "click", ("p1",), ("p1",)),
        ("t6", "purchase", ("p1",), ("p1",)),
        ("t7", "error", ("p1",), ("p1",)),
    ),
    "switch": tuple(row for k, name in enumerate(("signup", "view", "click", "purchase", "error")) for row in (
        (f"t{2 * k + 1}", name, ("p1",), ("p2",)), (f"t{2 * k + 2}", name, ("p2",), ("p1",)))),
    "chat": (
        ("t1", "system", ("p1",), ("p1",)),
        ("t2", "user", ("p1",), ("p3",)),
        ("t3", "user", ("p2",), ("p3",)),
        ("t4", "assistant", ("p3",), ("p2",)),
    ),
}

FIRST_EVENTS = ("signup",)
LAST_EVENTS = ("purchase", "error")
