"""Small nets with known outcomes. Fixed values: (id, name, inputs, outputs), in file order."""

WALK = [
    ("t4", "stop", ["p4", "p2"], ["p5"]),
    ("t1", "go left", ["p1"], ["p2", "p3"]),
    ("t2", "go right", ["p1"], ["p2", "p4"]),
    ("t3", "turn back", ["p3"], ["p4"]),
]
DESK = [
    ("t4", "sit at desk", ["p3"], []),
    ("t1", "go to work", ["p1"], ["p2"]),
    ("t2", "go to work", ["p1"], ["p3"]),
    ("t3", "have coffee", ["p2"], ["p3"]),
]
MORNING = [
    ("t4", "start working", ["p4", "p3"], ["p11"]),
    ("t6", "go for a run", ["p10"], ["p6", "p4", "p7"]),
    ("t7", "shower", ["p7"], ["p8"]),
    ("t8", "change", ["p6"], ["p9"]),
    ("t9", "wake up", ["p1"], ["p10"]),
    ("t10", "go to work", ["p12"], ["p3"]),
    ("t1", "wake up", ["p1"], ["p2"]),
    ("t2", "go to work", ["p8", "p9"], ["p3"]),
    ("t3", "have coffee", ["p2"], ["p12", "p4"]),
]
NETS = {"walk": WALK, "desk": DESK, "morning": MORNING}

# model, events, expected final marking, status, missing, indices, unconsumed
GOLDEN = [
    ("walk", ["go left", "turn back", "stop"], ["p5"], "ok", [], [], []),
    ("walk", ["go left", "stop"], ["p5"], "ok", ["p4"], [1], ["p3"]),
    ("morning", ["wake up", "have coffee", "go to work", "start working"], ["p11"], "ok", [], [], []),
    ("morning", ["wake up", "go for a run", "change", "go to work", "start working"], ["p11"], "ok", ["p8"], [3], ["p7"]),
    ("walk", ["go right", "stop"], [], "ok", [], [], ["p5"]),
    ("walk", ["go left", "stop"], [], "ok", ["p4"], [1], ["p3", "p5"]),
    ("desk", ["go to work", "sit at desk"], [], "ok", [], [], []),
    ("desk", ["go to work", "have coffee", "sit at desk"], [], "ok", [], [], []),
    ("walk", ["go left", "fly"], ["p5"], "unknown_event", [], [], []),
]
