"""DuckDB SQL for every query, written from the definitions rather than from the Spark plans.

Replay is a recursive query that fires one event per step on a list of candidate
markings, each a sorted list of tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from tracefold.demo import FIRST_EVENTS, LAST_EVENTS, NETS

AS_OF = "2024-02-01"
MICROS = "'%Y-%m-%d %H:%M:%S.%f'"


def names(values: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]::VARCHAR[]"


# --- logs and sessions -------------------------------------------------------------

USER_LOG = "SELECT CAST(user_id AS VARCHAR) AS case_id, ts, event_type AS event FROM events"
DAY_LOG = ("SELECT CAST(user_id AS VARCHAR) || '@' || strftime(ts, '%Y-%m-%d') AS case_id, ts, event_type AS event "
           "FROM events")
MEMBER_LOG = DAY_LOG + " WHERE user_id % 10 <> 0 AND ts IS NOT NULL AND event_type IS NOT NULL"
OUTCOME = "CASE WHEN status <> 'ok' THEN status WHEN len(mt) = 0 AND len(tok) = 0 THEN 'conformant' ELSE 'deviating' END"
SHARD_LOG = "SELECT CAST(user_id % 20 AS VARCHAR) AS case_id, ts, event_type AS event FROM events"
QUARTER_LOG = "SELECT CAST(user_id % 4 AS VARCHAR) AS case_id, ts, event_type AS event FROM events"
HOUR_LOG = ("SELECT CAST(user_id AS VARCHAR) || '@' || strftime(ts, '%Y-%m-%d %H') AS case_id, ts, event_type AS event "
            "FROM events")
CHAT_LOG = "SELECT CAST(conv_id AS VARCHAR) AS case_id, turn AS ts, role AS event FROM conversations"


def ordered(log: str) -> str:
    return f"""log AS ({log}),
ordered AS (SELECT case_id, ts, event, row_number() OVER (PARTITION BY case_id ORDER BY ts, event) - 1 AS pos FROM log),
bounds AS (
  SELECT case_id,
    min(pos) FILTER (WHERE list_contains({names(FIRST_EVENTS)}, event)) AS first_pos,
    max(pos) FILTER (WHERE list_contains({names(LAST_EVENTS)}, event)) AS last_pos
  FROM ordered GROUP BY case_id)"""


TRIMMED = """trimmed AS (
  SELECT o.case_id, o.pos - b.first_pos AS pos, o.ts, o.event FROM ordered o JOIN bounds b USING (case_id)
  WHERE b.last_pos >= b.first_pos AND o.pos BETWEEN b.first_pos AND b.last_pos)"""


def session_rows(condition: str, pos: str = "o.pos") -> str:
    return f"""WITH {ordered(DAY_LOG)}
SELECT o.case_id, CAST({pos} AS BIGINT) AS pos, o.event FROM ordered o JOIN bounds b USING (case_id) WHERE {condition}"""


def grouped(source: str) -> str:
    return f"""SELECT case_id, CAST(pos // 2048 AS BIGINT) AS segment,
  string_agg(strftime(ts, {MICROS}), ',' ORDER BY pos) AS timestamps, string_agg(event, ',' ORDER BY pos) AS events
FROM {source} GROUP BY ALL"""


# days from their first start event on
FRONT_LOG = f"""SELECT case_id, ts, event FROM (
  SELECT *, min(nr) FILTER (WHERE list_contains({names(FIRST_EVENTS)}, event)) OVER (PARTITION BY case_id) AS first_nr
  FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY ts, event) AS nr FROM ({DAY_LOG}))) WHERE nr >= first_nr"""


# --- replay ------------------------------------------------------------------------


def net_values(models: Sequence[str]) -> str:
    rows = [
        f"('{model}', {k}, '{t}', '{event}', {names(ins)}, {names(outs)})"
        for model in models for k, (t, event, ins, outs) in enumerate(NETS[model])
    ]
    return "trs(model_id, ord, transition_id, event, ins, outs) AS (VALUES " + ",\n  ".join(rows) + ")"


def fired(marking: str, transition: str) -> str:
    """A marking struct after a transition: missing inputs are noted, all inputs taken, outputs added."""
    absent = f"list_filter({transition}.ins, lambda p: NOT list_contains({marking}.tok, p))"
    filled = f"list_concat({marking}.tok, {absent})"
    taken = (f"list_filter({filled}, lambda x, k: NOT (list_contains({transition}.ins, x) "
             f"AND list_position({filled}, x) = k))")
    return (f"struct_pack(tok := list_sort(list_concat({taken}, {transition}.outs)), "
            f"mt := list_concat({marking}.mt, {absent}), "
            f"mi := list_concat({marking}.mi, list_transform({absent}, lambda p: i)))")


def ratio(marking: str, transition: str) -> str:
    return (f"CASE WHEN len({transition}.ins) = 0 THEN 0.0 ELSE "
            f"len(list_filter({transition}.ins, lambda q: NOT list_contains({marking}.tok, q)))::DOUBLE / len({transition}.ins) END")


def replay(log: str, finals: dict[str, Sequence[str]], trim: bool = True) -> str:
    """CTEs up to ``result``: one row per model and session, lists not yet turned to text."""
    models = list(finals)
    source = "trimmed" if trim else "ordered"
    tied = (f"list_filter(choices, lambda t: {ratio('m', 't')} = "
            f"list_min(list_transform(choices, lambda u: {ratio('m', 'u')})))")
    steps = []
    for k in range(max(len(f) for f in finals.values())):
        prior = "open0" if k == 0 else f"open{k}"
        wanted = "CASE model_id " + " ".join(
            f"WHEN '{m}' THEN {repr(f[k]) if k < len(f) else 'NULL'}" for m, f in finals.items()) + " END"
        steps.append(f"""open{k + 1} AS (
  SELECT model_id, case_id, err, unk, n,
    CASE WHEN w IS NULL THEN tok ELSE list_filter(tok, lambda x, k: NOT (x = w AND list_position(tok, w) = k)) END AS tok,
    CASE WHEN w IS NULL OR list_contains(tok, w) THEN mt ELSE list_append(mt, w) END AS mt,
    CASE WHEN w IS NULL OR list_contains(tok, w) THEN mi ELSE list_append(mi, n) END AS mi
  FROM (SELECT *, CAST({wanted} AS VARCHAR) AS w FROM {prior}))""")
    last = f"open{len(steps)}"
    return f"""WITH RECURSIVE {ordered(log)},
{TRIMMED},
{net_values(models)},
sess AS (
  SELECT m.model_id, case_id, list(event ORDER BY pos) AS events, CAST(count(*) AS BIGINT) AS n
  FROM {source}, (SELECT DISTINCT model_id FROM trs) m GROUP BY ALL),
opts AS (
  SELECT model_id, event, list(struct_pack(ins := ins, outs := outs) ORDER BY ord) AS choices FROM trs GROUP BY ALL),
r(model_id, case_id, i, buf, err, unk) AS (
  SELECT model_id, case_id, CAST(0 AS BIGINT), [struct_pack(tok := ['p1']::VARCHAR[], mt := []::VARCHAR[], mi := []::BIGINT[])],
    CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM sess
  UNION ALL
  SELECT model_id, case_id, i + 1, buf,
    CASE WHEN unk IS NOT NULL THEN 'unknown_event' WHEN len(buf) > 100 THEN 'path_explosion' END, unk
  FROM (
    SELECT * REPLACE (CASE WHEN len(buf) < 2 THEN buf ELSE
      list_filter(buf, lambda x, k: len(list_filter(buf[:k - 1], lambda y: y.tok = x.tok)) = 0) END AS buf)
    FROM (
      SELECT * REPLACE (CASE WHEN len(buf) < 2 THEN buf ELSE
        list_filter(buf, lambda m: len(m.mt) = list_min(list_transform(buf, lambda o: len(o.mt)))) END AS buf)
      FROM (
        SELECT model_id, case_id, i, unk, CASE WHEN unk IS NOT NULL THEN buf ELSE list_concat(
          flatten(list_filter(fam, lambda f: len(f) = 1)), flatten(list_reverse(list_filter(fam, lambda f: len(f) > 1)))) END AS buf
        FROM (
          SELECT r.model_id, r.case_id, i, buf, CASE WHEN choices IS NULL THEN events[i + 1] END AS unk,
            list_transform(buf, lambda m: list_transform({tied}, lambda t: {fired('m', 't')})) AS fam
          FROM r JOIN sess USING (model_id, case_id)
          LEFT JOIN opts ON opts.model_id = r.model_id AND opts.event = events[i + 1]
          WHERE r.err IS NULL AND i < n))))),
open0 AS (
  SELECT model_id, case_id, r.err, r.unk, n, buf[1].tok AS tok, buf[1].mt AS mt, buf[1].mi AS mi
  FROM r JOIN sess USING (model_id, case_id) WHERE r.err IS NOT NULL OR i = n),
{"".join(s + "," + chr(10) for s in steps)}result AS (
  SELECT model_id, case_id, coalesce(err, 'ok') AS status,
    CASE err WHEN 'unknown_event' THEN unk WHEN 'path_explosion' THEN '100' ELSE '' END AS error_detail,
    CASE WHEN err IS NULL THEN mt ELSE [] END AS mt, CASE WHEN err IS NULL THEN mi ELSE [] END AS mi,
    CASE WHEN err IS NULL THEN list_sort(tok) ELSE [] END AS tok, n
  FROM {last})"""


FLAT = """SELECT {model}case_id, status, error_detail, array_to_string(mt, ',') AS missing_tokens,
  array_to_string(mi, ',') AS missing_indices, array_to_string(tok, ',') AS unconsumed_tokens, n AS session_length
FROM result"""


LEDGER = """
SELECT model_id, case_id, kind, "at", place_id, count(*) AS tokens FROM (
  SELECT model_id, case_id, 'missing' AS kind, unnest(mi) AS "at", unnest(mt) AS place_id FROM result
  UNION ALL
  SELECT model_id, case_id, 'left', n, unnest(tok) FROM result) GROUP BY ALL"""


def check(log: str, model: str, final: Sequence[str], trim: bool = True) -> str:
    return replay(log, {model: final}, trim) + "\n" + FLAT.format(model="")


def quoted(items: str) -> str:
    return f"'[' || array_to_string(list_transform({items}, lambda x: '''' || x || ''''), ', ') || ']'"


def report(model: str, area: str) -> str:
    """CTEs up to ``report``: the nine text columns."""
    return replay(DAY_LOG, {model: ["p2"]}) + f""",
report AS (
  SELECT case_id, '{area}' AS area, strftime(DATE '{AS_OF}' - INTERVAL 1 DAY, '%Y-%m-%d 00:00:00') AS report_date,
    '{model}.pnml' AS model_file,
    coalesce(e, {quoted('mt')}) AS missing_tokens, {quoted('tok')} AS unconsumed_tokens,
    CAST(coalesce(length(e), len(mt)) AS VARCHAR) AS missing_count, CAST(len(tok) AS VARCHAR) AS unconsumed_count,
    CAST(n AS VARCHAR) AS session_length
  FROM (SELECT *, CASE status WHEN 'unknown_event' THEN 'unknown Event: ' || error_detail
    WHEN 'path_explosion' THEN 'Path Explosion: over 100 paths in buffer' END AS e FROM result))
"""


def with_context(log: str, model: str, trim: bool = True) -> str:
    """CTEs up to ``reported``: results with the text around each missing token."""
    piece = "CASE WHEN i = 0 THEN '(>> ' || array_to_string(events[1:3], ' > ') || ')'" \
        " WHEN i = n - 1 THEN '(' || events[n - 2] || ' > ' || events[n - 1] || ' >> ' || events[n] || ')'" \
        " WHEN i = n THEN '(' || array_to_string(events[n - 2:n], ' > ') || ' >>)'" \
        " ELSE '(' || events[i] || ' >> ' || events[i + 1] || ' > ' || events[i + 2] || ')' END"
    return replay(log, {model: ["p2"]}, trim) + f""",
reported AS (
  SELECT result.*, CASE WHEN n = 1 THEN '(>> ' || events[1] || ')' WHEN n = 2 THEN '(' || events[1] || ' >> ' || events[2] || ')'
    ELSE array_to_string(list_transform(mi, lambda i: {piece}), ';') END AS surrounding_events
  FROM (SELECT * FROM result) result JOIN (SELECT case_id, events FROM sess) USING (case_id))
"""


# --- model tables ------------------------------------------------------------------

ORDER_NETS = """lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS model_id, CAST(l_linenumber AS INTEGER) AS line, 't' || l_linenumber AS tid,
    l_suppkey % 10 AS supp, l_partkey % 10 AS part, l_returnflag, l_linestatus, l_tax, l_discount FROM lineitem),
transitions AS (
  SELECT model_id, line AS trans_ord, tid AS transition_id, min(l_returnflag) AS name FROM lines GROUP BY ALL),
arcs AS (
  SELECT model_id, 2 * line AS arc_ord, CASE WHEN l_tax = 0 THEN 's' ELSE 'p' END || supp AS source, tid AS target
  FROM lines WHERE l_linestatus = 'O'
  UNION ALL
  SELECT model_id, 2 * line + 1, tid, 'p' || part FROM lines WHERE l_discount > 0.02),
places AS (
  SELECT model_id, 'order-' || model_id || '.pnml' AS model_file, CAST(k AS INTEGER) AS place_ord, 'p' || k AS place_id,
    'place ' || k AS name, CAST(max(init) AS INTEGER) AS init_tokens
  FROM (SELECT model_id, supp AS k, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS init FROM lines
        UNION ALL SELECT model_id, part, 0 FROM lines) GROUP BY model_id, k),
tops AS (SELECT model_id, max(arc_ord) + 1 AS base FROM arcs GROUP BY model_id)"""


def sides(arcs: str = "arcs") -> str:
    """Arcs seen from their transition, each place once per side."""
    return f"""(SELECT model_id, CASE WHEN source[1] = 'p' THEN target ELSE source END AS transition_id,
    CASE WHEN source[1] = 'p' THEN 'in' ELSE 'out' END AS side,
    CASE WHEN source[1] = 'p' THEN source ELSE target END AS place_id, CAST(min(arc_ord) AS INTEGER) AS arc_ord
  FROM {arcs} WHERE source[1] IN ('p', 't') GROUP BY ALL)"""


def without_side(side: str) -> str:
    return f"""WITH {ORDER_NETS}
SELECT model_id, transition_id FROM transitions t WHERE NOT EXISTS (
  SELECT 1 FROM {sides()} s WHERE s.model_id = t.model_id AND s.transition_id = t.transition_id AND side = '{side}')"""


MARKINGS = f"""log AS (
  SELECT CAST(user_id AS VARCHAR) || '@' || strftime(ts, '%Y-%m-%d') AS marking_id, event_type AS event,
    'p' || (event_id % 6 + 1) AS place FROM events), {net_values(["shop_amb"])},
kinds AS (SELECT DISTINCT marking_id, event FROM log),
held AS (SELECT marking_id, list(DISTINCT place) AS tokens FROM log GROUP BY marking_id),
ratios AS (
  SELECT marking_id, event, transition_id,
    CASE WHEN len(ins) = 0 THEN 0.0 ELSE len(list_filter(ins, lambda p: NOT list_contains(tokens, p)))::DOUBLE / len(ins) END AS ratio
  FROM kinds JOIN held USING (marking_id) JOIN trs USING (event))"""


def all_sql() -> dict[str, str]:
    shop_final = ["p2"]
    sql = {
        "delimited_scan": f"""WITH f AS (
  SELECT string_split(concat_ws('|', event_id, strftime(ts, {MICROS}), user_id, event_type, CAST(value AS DECIMAL(18, 2)), props), '|') AS p
  FROM events)
SELECT p[1] AS event_id, p[2] AS ts, p[3] AS user_id, p[4] AS event_type, p[5] AS value, p[6] AS props,
  CAST(len(p) AS INTEGER) AS n_fields FROM f""",
        "extract_event_log": f"SELECT case_id, strftime(ts, {MICROS}) AS ts, event FROM ({USER_LOG})",
        "group_sessions": f"WITH {ordered(USER_LOG)}\n{grouped('ordered')}",
        "sort_sessions": f"WITH {ordered(USER_LOG)}\nSELECT case_id, CAST(pos AS BIGINT) AS pos, event FROM ordered",
        "sessions_with_start": session_rows("b.first_pos IS NOT NULL"),
        "trim_start": session_rows("o.pos >= b.first_pos", "o.pos - b.first_pos"),
        "complete_sessions": session_rows("o.pos >= b.first_pos AND b.last_pos >= b.first_pos", "o.pos - b.first_pos"),
        "trim_end": session_rows("o.pos <= b.last_pos"),
        "trim_sessions": f"WITH {ordered(DAY_LOG)},\n{TRIMMED}\nSELECT case_id, CAST(pos AS BIGINT) AS pos, event FROM trimmed",
        "extract_logs": f"WITH {ordered(USER_LOG)},\n{TRIMMED}\n{grouped('trimmed')}",
        "session_length": f"WITH {ordered(DAY_LOG)},\n{TRIMMED}\nSELECT case_id, count(*) AS session_length FROM trimmed GROUP BY case_id",
        "model_places": f"""WITH {ORDER_NETS}
SELECT model_id, model_file, place_ord, place_id, name, init_tokens FROM places
UNION ALL
SELECT model_id, min(model_file), CAST(max(place_ord) + 1 AS INTEGER), 'p100', 'end', 0 FROM places GROUP BY model_id""",
        "model_transition_lookup": f"""WITH {ORDER_NETS}
SELECT model_id, name, trans_ord, transition_id FROM transitions
UNION ALL
SELECT model_id, 'A', CAST(max(trans_ord) + 1 AS INTEGER), 't100' FROM transitions GROUP BY model_id""",
        "model_arcs": f"""WITH {ORDER_NETS},
more AS (
  SELECT * FROM arcs
  UNION ALL SELECT model_id, coalesce(base, 0) + k, source, target
  FROM (SELECT DISTINCT model_id FROM transitions) LEFT JOIN tops USING (model_id),
    (VALUES (0, 'p1', 't100'), (1, 'p2', 't100')) v(k, source, target)),
tops2 AS (SELECT model_id, max(arc_ord) + 1 AS base FROM more GROUP BY model_id),
all_arcs AS (SELECT * FROM more UNION ALL SELECT model_id, base, 't100', 'p100' FROM tops2)
SELECT * FROM {sides('all_arcs')}""",
        "model_scan": """WITH pairs AS (SELECT CAST(c_nationkey AS VARCHAR) AS model_id, o_orderstatus AS s, o_orderpriority AS t, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT model_id, 'place' AS kind, CAST(row_number() OVER (PARTITION BY model_id ORDER BY s) - 1 AS INTEGER) AS ord, 'p' || s AS id,
  ' status ' || s || ' ' AS name, CASE WHEN s IN ('O', 'F') THEN '1' ELSE '0' END AS more FROM (SELECT DISTINCT model_id, s FROM pairs)
UNION ALL
SELECT model_id, 'transition', CAST(row_number() OVER (PARTITION BY model_id ORDER BY t) - 1 AS INTEGER), 't' || t[1], t, ''
FROM (SELECT DISTINCT model_id, t FROM pairs)
UNION ALL
SELECT model_id, 'arc', CAST(row_number() OVER (PARTITION BY model_id ORDER BY s, t) - 1 AS INTEGER),
  CASE WHEN n % 2 = 0 THEN 'p' || s ELSE 't' || t[1] END, '', CASE WHEN n % 2 = 0 THEN 't' || t[1] ELSE 'p' || s END FROM pairs""",
        "model_initial_marking": f"WITH {ORDER_NETS}\nSELECT model_id, place_id, init_tokens FROM places WHERE init_tokens > 0",
        "model_delete_transition": f"""WITH {ORDER_NETS},
kept AS (SELECT * FROM transitions WHERE name <> 'N')
SELECT model_id, transition_id, name, coalesce(side, '') AS side, coalesce(place_id, '') AS place_id
FROM kept LEFT JOIN {sides()} USING (model_id, transition_id)""",
        "model_merge_transitions": f"""WITH {ORDER_NETS},
ends AS (SELECT model_id, 't' || min(line) AS tid, 't' || max(line) AS other FROM lines GROUP BY model_id HAVING min(line) < max(line)),
lent AS (SELECT model_id, tid, side, place_id, s.arc_ord + base AS arc_ord
  FROM {sides()} s JOIN ends USING (model_id) JOIN tops USING (model_id) WHERE s.transition_id = other),
merged AS (SELECT * FROM {sides()} UNION ALL SELECT model_id, tid, side, place_id, arc_ord FROM lent)
SELECT model_id, transition_id, side, place_id, CAST(min(arc_ord) AS INTEGER) AS arc_ord FROM merged GROUP BY ALL""",
        "model_edit_log": f"""WITH {ORDER_NETS},
o AS (SELECT CAST(o_orderkey AS VARCHAR) AS model_id, o_orderstatus AS st, o_orderpriority[1] AS pr FROM orders),
arcs0 AS (
  SELECT * FROM arcs
  UNION ALL SELECT model_id, base + arc_ord, replace(source, 't3', 't2'), replace(target, 't3', 't2') FROM arcs JOIN tops USING (model_id)
  WHERE model_id IN (SELECT model_id FROM o WHERE st = 'O') AND ((source[1] = 'p' AND target = 't3') OR source = 't3')),
tops0 AS (SELECT model_id, max(arc_ord) + 1 AS base FROM arcs0 GROUP BY model_id),
arcs1 AS (
  SELECT * FROM arcs0
  UNION ALL SELECT model_id, coalesce(base, 0) + k, source, target FROM o LEFT JOIN tops0 USING (model_id),
    (VALUES (0, 'p1', 't100'), (1, 'p2', 't100'), (2, 't100', 'p100')) v(k, source, target) WHERE pr = '1'),
trans1 AS (
  SELECT model_id, trans_ord, transition_id, name FROM transitions
  UNION ALL SELECT model_id, coalesce(max(trans_ord) + 1, 0), 't100', 'A' FROM o LEFT JOIN transitions USING (model_id) WHERE pr = '1' GROUP BY model_id),
drop1 AS (SELECT model_id FROM o WHERE st = 'F'),
arcs2 AS (SELECT * FROM arcs1 WHERE NOT (model_id IN (FROM drop1) AND CASE WHEN source[1] = 't' THEN source ELSE target END = 't1')),
trans2 AS (SELECT * FROM trans1 WHERE NOT (model_id IN (FROM drop1) AND transition_id = 't1')),
ends AS (SELECT model_id, pr, CASE WHEN pr IN ('1', '2') THEN '_b' ELSE '' END AS suffix FROM o),
arcs3 AS (SELECT model_id, arc_ord, source || coalesce(suffix, '') AS source, target || coalesce(suffix, '') AS target FROM arcs2 LEFT JOIN ends USING (model_id)),
tops3 AS (SELECT model_id, max(arc_ord) + 1 AS base FROM arcs3 GROUP BY model_id)
SELECT model_id, 'place' AS kind, place_ord AS ord, place_id || coalesce(suffix, '') AS id, name AS more FROM places LEFT JOIN ends USING (model_id)
UNION ALL SELECT model_id, 'place', CAST(coalesce(max(place_ord) + 1, 0) AS INTEGER), 'p100', 'end' FROM o LEFT JOIN places USING (model_id) GROUP BY model_id
UNION ALL SELECT model_id, 'transition', CAST(trans_ord AS INTEGER), transition_id || coalesce(suffix, ''), name FROM trans2 LEFT JOIN ends USING (model_id)
UNION ALL SELECT model_id, 'arc', CAST(arc_ord AS INTEGER), source, target FROM arcs3
UNION ALL SELECT model_id, 'arc', CAST(coalesce(base, 0) AS INTEGER), 'p100', 't1' FROM ends LEFT JOIN tops3 USING (model_id) WHERE pr = '2'""",
        "model_suffix_ids": f"""WITH {ORDER_NETS}
SELECT model_id, transition_id || '_b' AS transition_id, side, place_id || '_b' AS place_id, arc_ord, init_tokens
FROM {sides()} JOIN places USING (model_id, place_id)""",
        "model_input_transitions": without_side("in"),
        "model_output_transitions": without_side("out"),
        "event_transition_lookup": f"""WITH log AS ({USER_LOG}), {net_values(["shop_amb"])}
SELECT case_id, strftime(ts, {MICROS}) AS ts, event, transition_id, CAST(ord AS INTEGER) AS trans_ord FROM log JOIN trs USING (event)""",
        "transition_missing_ratio": f"WITH {MARKINGS}\nSELECT marking_id, event, transition_id, ratio FROM ratios",
        "least_missing_transitions": f"""WITH {MARKINGS}
SELECT marking_id, event, transition_id, ratio FROM ratios r
WHERE ratio = (SELECT min(ratio) FROM ratios o WHERE o.marking_id = r.marking_id AND o.event = r.event)""",
        "replay_deterministic": check(USER_LOG, "shop", []),
        "final_marking": check(DAY_LOG, "shop", ["p2", "p5", "p2"]),
        "check_logs": check(DAY_LOG, "shop_noerror", shop_final),
        "replay_ambiguous": check(CHAT_LOG, "chat", [], trim=False),
        "check_logs_ambiguous": check(DAY_LOG, "shop_amb", shop_final),
        "replay_path_explosion": check(USER_LOG, "explode", ["p1"], trim=False),
        "conformance_multi_model": " UNION ALL ".join(f"SELECT * FROM ({q})" for q in (
            replay(DAY_LOG, {"shop": shop_final, "shop_amb": shop_final, "shop_noerror": ["p2", "p3"]}) + "\n" + FLAT.format(model="model_id, "),
            replay(DAY_LOG, {"shop": shop_final}, trim=False) + "\n" + FLAT.format(model="'shop_whole' AS model_id, "),
            replay(FRONT_LOG, {"shop_amb": shop_final}, trim=False) + "\n" + FLAT.format(model="'shop_front' AS model_id, "))),
        "unknown_events": f"""SELECT case_id, strftime(ts, {MICROS}) AS ts, event FROM ({USER_LOG})
WHERE event NOT IN ({", ".join(sorted({repr(t[1]) for t in NETS["shop_noerror"]}))})""",
        "conformance_report": report("shop", "shop") + "SELECT * FROM report",
        "report_lines": report("shop_noerror", "shop") + """SELECT concat_ws('|', case_id, area, report_date, model_file,
  missing_tokens, unconsumed_tokens, missing_count, unconsumed_count, session_length) AS line FROM report""",
        "save_report": report("shop_noerror", "strict") + "SELECT * FROM report",
        "surrounding_events": " UNION ALL ".join(
            f"SELECT * FROM ({with_context(log, 'shop', trim=False)}SELECT case_id, n AS session_length, surrounding_events FROM reported)"
            for log in (HOUR_LOG, USER_LOG)),
        "sort_sessions_hot": f"WITH {ordered(QUARTER_LOG)}\nSELECT case_id, CAST(pos AS BIGINT) AS pos, event FROM ordered",
        "trim_sessions_hot": f"WITH {ordered(QUARTER_LOG)},\n{TRIMMED}\nSELECT case_id, CAST(pos AS BIGINT) AS pos, event FROM trimmed",
        "replay_scan_hot": check(QUARTER_LOG, "shop", shop_final),
        "check_logs_long": replay(QUARTER_LOG, {"shop_amb": shop_final, "switch": shop_final}, trim=False) + "\n" + FLAT.format(model="model_id, "),
        "check_logs_segments": replay(SHARD_LOG, {"shop_amb": shop_final, "switch": shop_final}, trim=False) + "\n" + FLAT.format(model="model_id, "),
        "check_logs_prefixes": check(DAY_LOG, "shop_amb", shop_final),
        "missing_steps": replay(DAY_LOG, {"shop": shop_final, "shop_amb": shop_final}) + LEDGER,
        "missing_steps_hot": replay(SHARD_LOG, {"shop": shop_final, "shop_amb": shop_final, "switch": shop_final}, trim=False) + LEDGER,
        "generate_report": with_context(DAY_LOG, "shop") + """SELECT case_id, status, error_detail, array_to_string(mt, ',') AS missing_tokens,
  array_to_string(mi, ',') AS missing_indices, array_to_string(tok, ',') AS unconsumed_tokens, n AS session_length,
  surrounding_events FROM reported""",
        "outcome_counts": replay(DAY_LOG, {"shop_noerror": shop_final, "shop_amb": shop_final}) + f"""
SELECT model_id, {OUTCOME} AS outcome, count(*) AS sessions FROM result GROUP BY ALL""",
        "run_counters": replay(MEMBER_LOG, {"shop_noerror": shop_final}) + f""",
outcomes AS (SELECT {OUTCOME} AS outcome, len(mt) AS missing, n FROM result)
SELECT 'rows' AS counter, count(*) AS value FROM events
UNION ALL SELECT 'rejected_rows', count(*) FILTER (user_id IS NULL OR user_id % 10 = 0 OR ts IS NULL OR event_type IS NULL) FROM events
UNION ALL SELECT name, count(outcome) FROM (VALUES ('conformant'), ('deviating'), ('unknown_event'), ('path_explosion')) v(name)
  LEFT JOIN outcomes ON outcome = name GROUP BY name
UNION ALL SELECT 'missing_tokens', CAST(coalesce(sum(missing), 0) AS BIGINT) FROM outcomes
UNION ALL SELECT 'session_events', CAST(1000 + coalesce(sum(n), 0) AS BIGINT) FROM outcomes""",
    }
    return sql
