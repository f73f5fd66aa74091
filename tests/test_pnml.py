import pytest

from fixtures import NETS
from tracefold.local import nets_from_rows
from tracefold.sources.pnml import read_models


def place(pid, name, mark=""):
    marking = f"<initialMarking><text>{mark}</text></initialMarking>" if mark else ""
    return (f'<place id="{pid}"><name><text>{name}</text><graphics><offset x="4" y="6"/></graphics></name>'
            f'<graphics><position x="1" y="2"/></graphics>{marking}</place>')


def transition(tid, name):
    return f'<transition id="{tid}"><name><text>{name}</text></name><toolspecific tool="x" version="1"><time>0</time></toolspecific></transition>'


def arcs_of(rows):
    ends = [e for t, _, ins, outs in rows for e in [*((p, t) for p in ins), *((t, p) for p in outs)]]
    return "".join(
        f'<arc id="a{k}" source="{s}" target="{t}"><inscription><text>2</text></inscription></arc>' for k, (s, t) in enumerate(ends))


def document(rows, marked=("p1",)):
    places = sorted({p for _, _, ins, outs in rows for p in (*ins, *outs)})
    body = "".join(place(p, f"name {p}", "3" if p in marked else "") for p in places)
    body += "".join(transition(t, n) for t, n, _, _ in rows) + arcs_of(rows)
    return body


def write(path, *nets):
    inner = "".join(f'<net type="x" id="n{k}">{net}</net>' for k, net in enumerate(nets))
    path.write_text(f'<?xml version="1.0" encoding="UTF-8"?>\n<!--made by hand-->\n<pnml>{inner}</pnml>')


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_models_are_read_as_tables(spark, tmp_path):
    for name, net in NETS.items():
        write(tmp_path / f"{name}.pnml", document(net))
    read, made = read_models(spark, str(tmp_path)), nets_from_rows(spark, NETS)
    assert rows(read.transitions) == rows(made.transitions)
    assert rows(read.arcs) == rows(made.arcs)
    columns = ["model_id", "model_file", "place_id", "init_tokens"]
    # a marking of 3 is one token
    assert rows(read.places.select(columns)) == rows(made.places.select(columns))
    assert read.places.where("model_id = 'walk' AND place_id = 'p2'").first().name == "name p2"


def test_only_the_first_net_and_its_own_elements_count(spark, tmp_path):
    page = f'<page id="g"><place id="p77"><name><text>n</text></name></place></page>'
    write(tmp_path / "two.pnml", document(NETS["walk"]) + page, document(NETS["desk"]))
    read = read_models(spark, str(tmp_path / "two.pnml"))
    assert {r.name for r in read.transitions.collect()} == {n for _, n, _, _ in NETS["walk"]}
    assert "p77" not in {r.place_id for r in read.places.collect()}


def test_a_net_without_transitions_has_places_only(spark, tmp_path):
    write(tmp_path / "bare.pnml", place("p1", "alone"))
    read = read_models(spark, str(tmp_path))
    assert rows(read.places) == [("bare", "bare.pnml", 0, "p1", "alone", 0)]
    assert read.transitions.count() == 0 and read.arcs.count() == 0


def test_names_are_kept_as_written(spark, tmp_path):
    write(tmp_path / "blank.pnml", place("p1", " at ease ") + transition("t1", " view "))
    read = read_models(spark, str(tmp_path))
    assert read.places.first().name == " at ease " and read.transitions.first().name == " view "


def test_a_place_without_a_name_is_refused(spark, tmp_path):
    write(tmp_path / "bare.pnml", '<place id="p1"/>')
    with pytest.raises(Exception, match="no name"):
        read_models(spark, str(tmp_path)).places.collect()
