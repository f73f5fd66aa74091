"""Replay on models where several transitions share an event name.

Which transition fires depends on the tokens held, and ties keep several markings
alive, so a session is a fold over its events. The fold is one native ``aggregate``
over the events of a segment, with places and event names as small integers.

A longer session is folded in segments, stretch by stretch. If sessions are few, the
segments of a stretch first run at once from a guess; such a result holds for all starts
from which each test for a token would come out the same. Then they are gone through in
order: a segment whose true start the guess holds for is taken over, others are folded from
that start. Results are exact, and nothing is folded behind an explosion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracefold.cluster import cut_lineage, task_slots
from tracefold.local import local_table
from tracefold.operators.context import TEXTS, with_texts
from tracefold.operators.automaton import EXPLODED, Automaton, compile_automata, start_states
from tracefold.operators.models import Nets, transition_arcs
from tracefold.operators.prefix_tree import fold_tree
from tracefold.operators.sessions import CHUNKS_PER_SLOT, SEGMENT_EVENTS, Piece, Sessions, union_all, with_session_values
from tracefold.schemas import STATUS_OK, STATUS_PATH_EXPLOSION, STATUS_UNKNOWN_EVENT

PATH_LIMIT = 100
# events from which it pays to compile the nets for sessions of one segment too
COMPILE_FROM = 200_000
SESSION = ["model_id", "case_id"]

# A marking: tokens per place, the marking of the segment start it came from, how many
# tokens went missing since then, and which: event * places + place number, each followed by
# a comma. As text they are cheap to copy, which happens at every step.
MARKING = "struct<tok:array<int>,org:int,lost:int,miss:string>"
STATE = f"struct<buf:array<{MARKING}>,pos:int,exploded:boolean,low:array<int>>"
NEVER_TESTED = 2**31 - 1
GUESS = "struct<toks:array<array<int>>,toks_out:array<array<int>>,orgs:array<int>,misses:array<string>,low:array<int>,exploded:boolean>"
RELAYED = "struct<segment:bigint,toks_out:array<array<int>>,orgs:array<int>,misses:array<string>,exploded:boolean,held:boolean>"
RELAY = f"struct<toks:array<array<int>>,exploded:boolean,out:array<{RELAYED}>>"
# events of a session that a row folds, in the first round and at the most
FIRST_STRETCH = 1 << 14
LAST_STRETCH = 1 << 18
OPTIONS = "array<array<struct<ins:array<int>,outs:array<int>>>>"


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def event_options(nets: Nets, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Models as numbers: (model_id, event, label) and one row of arrays per model.

    The model row holds the place names in order, the initial token counts, and per
    label its transitions in file order: input places in arc order and output places. Its
    size is that of the model's arcs.
    """
    arcs = transition_arcs(nets)
    wanted = expected.select("model_id", F.explode("expected_final").alias("place_id"))
    places = (
        nets.places.select("model_id", "place_id", "init_tokens")
        .unionByName(arcs.select("model_id", "place_id"), allowMissingColumns=True)
        .unionByName(wanted, allowMissingColumns=True)
        .groupBy("model_id", "place_id").agg(F.coalesce(F.max("init_tokens"), F.lit(0)).alias("init"))
        .groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("place_id", "init"))).alias("p"))
        .select("model_id", F.col("p.place_id").alias("names"), F.col("p.init").alias("init"))
    )
    arc = F.when(F.col("place_id").isNotNull(), F.struct("arc_ord", "side", "place_id"))
    on_side = lambda side: F.transform(
        F.filter("arcs", lambda a: a["side"] == side), lambda a: (F.array_position("names", a["place_id"]) - 1).cast("int"))
    transitions = (
        nets.transitions.join(arcs, ["model_id", "transition_id"], "left")
        .groupBy("model_id", "name", "trans_ord", "transition_id")
        .agg(F.sort_array(F.collect_list(arc)).alias("arcs"))
        .join(places.select("model_id", "names"), "model_id")
        .select(
            "model_id", "name", "trans_ord",
            on_side("in").alias("ins"), on_side("out").alias("outs"))
    )
    labels = (
        transitions.groupBy("model_id", "name")
        .agg(F.sort_array(F.collect_list(F.struct("trans_ord", "ins", "outs"))).alias("ts"))
        .groupBy("model_id").agg(F.sort_array(F.collect_list(F.struct("name", "ts"))).alias("labels"))
    )
    models = (
        places.join(labels, "model_id").join(expected, "model_id")
        .select(
            "model_id", "names", "init",
            F.transform("labels", lambda l: F.transform(l["ts"], lambda t: F.struct(t["ins"], t["outs"]))).cast(OPTIONS).alias("options"),
            F.transform("labels", lambda l: F.array_distinct(F.flatten(l["ts"]["ins"]))).alias("tests"),
            F.transform("expected_final", lambda p: (F.array_position("names", p) - 1).cast("int")).alias("final"))
    )
    numbered = labels.select("model_id", F.posexplode(F.col("labels.name")).alias("label", "event"))
    return numbered, models


# --- the step of the fold ---------------------------------------------------------


def _fire(marking: Column, transition: Column, pos: Column) -> Column:
    """The marking after a transition, with its empty input places noted as missing."""
    tokens = marking["tok"]
    width = F.size(tokens)
    absent = F.filter(transition["ins"], lambda p: tokens[p] == 0)
    missed = F.array_join(F.transform(absent, lambda p: F.concat((pos * width + p).cast("string"), F.lit(","))), "")
    taken = lambda place: F.array_contains(transition["ins"], place).cast("int")
    given = lambda place: F.array_contains(transition["outs"], place).cast("int")
    moved = F.transform(tokens, lambda n, p: F.greatest(n - taken(p), F.lit(0)) + given(p))
    return F.struct(moved.alias("tok"), marking["org"].alias("org"), (marking["lost"] + F.size(absent)).alias("lost"),
                    F.concat(marking["miss"], missed).alias("miss"))


def missing_codes(text: Column) -> Column:
    """The numbers behind ``miss``."""
    return F.filter(F.split(text, ","), lambda code: code != "").cast("array<bigint>")


def _missing_ratio(marking: Column, transition: Column) -> Column:
    absent = F.size(F.filter(transition["ins"], lambda p: marking["tok"][p] == 0))
    # a transition without input places is always enabled
    return F.when(absent == 0, F.lit(0.0)).otherwise(absent.cast("double") / F.size(transition["ins"]))


def _children(marking: Column, choices: Column, pos: Column) -> Column:
    """A marking after each of the transitions tied for the lowest missing ratio."""
    def keep_lowest(ratios: Column) -> Column:
        return F.filter(choices, lambda t, k: ratios[k] == F.array_min(ratios))
    lowest = F.when(F.size(choices) == 1, choices).otherwise(
        bind(F.transform(choices, lambda t: _missing_ratio(marking, t)), keep_lowest))
    return F.transform(lowest, lambda t: _fire(marking, t, pos))


def _advance(buffer: Column, choices: Column, pos: Column) -> Column:
    """All markings after an event: the unbranched in place, then the branched, last first."""
    def reorder(families: Column) -> Column:
        single = F.filter(families, lambda f: F.size(f) == 1)
        branched = F.filter(families, lambda f: F.size(f) > 1)
        return F.concat(F.flatten(single), F.flatten(F.reverse(branched)))
    return bind(F.transform(buffer, lambda m: _children(m, choices, pos)), reorder)


def _least_divergent(buffer: Column) -> Column:
    return bind(F.array_min(F.transform(buffer, lambda m: m["lost"])),
                lambda fewest: F.filter(buffer, lambda m: m["lost"] == fewest))


def _first_of_equals(buffer: Column) -> Column:
    """Drop markings whose tokens equal those of an earlier one."""
    def pick(keys: Column) -> Column:
        return bind(F.array_distinct(keys), lambda distinct: F.when(
            F.size(distinct) == F.size(keys), buffer,
        ).otherwise(F.transform(distinct, lambda k: F.get(buffer, (F.array_position(keys, k) - 1).cast("int")))))
    return bind(F.transform(buffer, lambda m: F.array_join(m["tok"].cast("array<string>"), ",")), pick)


def _trim(buffer: Column) -> Column:
    trimmed = bind(_least_divergent(buffer), _first_of_equals)
    return F.when(F.size(buffer) > 1, trimmed).otherwise(buffer)


def _step(state: Column, label: Column, watch: bool) -> Column:
    def settle(buffer: Column) -> Column:
        low = _lowest_tested(state, F.get("tests", label)) if watch else state["low"]
        return F.struct(buffer.alias("buf"), (state["pos"] + 1).alias("pos"),
                        (F.size(buffer) > PATH_LIMIT).alias("exploded"), low.alias("low"))
    advanced = _advance(state["buf"], F.get("options", label), state["pos"])
    moved = bind(bind(advanced, _trim), settle)
    return F.when(state["exploded"], state).otherwise(moved)


def _lowest_tested(state: Column, tested: Column) -> Column:
    """Per place the fewest tokens any marking held when the place was tested for a token."""
    fewest = lambda place: F.array_min(F.transform(state["buf"], lambda m: m["tok"][place]))
    return F.transform(state["low"], lambda low, place: F.when(
        F.array_contains(tested, place), F.least(low, fewest(place))).otherwise(low))


def fold_segment(rows: DataFrame, watch: bool = False) -> DataFrame:
    """Fold ``labels`` from the markings in ``toks``; adds ``state`` at the segment's end.

    ``watch`` also fills ``low``, what the outcome depends on: without it ``low`` stays empty.
    """
    return rows.withColumn("state", F.aggregate("labels", _opening(F.col("toks"), watch), lambda s, label: _step(s, label, watch)))


def _opening(toks: Column, watch: bool = False) -> Column:
    """The state before the first event."""
    markings = F.transform(toks, lambda tok, k: F.struct(
        tok.alias("tok"), k.alias("org"), F.lit(0).alias("lost"), F.lit("").alias("miss")))
    low = F.transform("init", lambda n: F.lit(NEVER_TESTED)) if watch else F.array().cast("array<int>")
    return F.struct(markings.alias("buf"), F.lit(0).alias("pos"), F.lit(False).alias("exploded"), low.alias("low")).cast(STATE)


def fold_part(rows: DataFrame) -> DataFrame:
    """Advance ``state`` over the labels in ``part``."""
    return rows.withColumn("state", F.aggregate("part", F.col("state").cast(STATE), lambda s, label: _step(s, label, False)))


# --- whole sessions ---------------------------------------------------------------


def label_segments(sessions: Sessions, labels: DataFrame, size: int, join, context: bool = False) -> DataFrame:
    """Sessions as arrays of event labels, ``size`` events per row, up to the first unknown event.

    ``context`` adds ``around``, the text of each of these events, and the session's other texts where they stand.
    """
    def one(piece: Piece) -> DataFrame:
        rows = join(piece.rows, labels, ["model_id", "event"], "left")
        unknown = F.min(F.when(F.col("label").isNull(), F.struct("pos", "event")))
        rows = with_session_values(piece.with_rows(rows), unknown=unknown).rows
        known = F.col("unknown").isNull() | (F.col("pos") < F.col("unknown.pos"))
        listed = lambda name: F.sort_array(F.collect_list(F.when(known, F.struct("pos", name))))[name].alias(name + "s" if name == "label" else name)
        texts = [listed("around"), F.max("around_end").alias("around_end"), F.max("short").alias("short")] if context else []
        session = ["model_id", *[k for k in piece.keys if k != "model_id"]]
        return (
            rows.where(known | (F.col("pos") == 0))
            .groupBy(*session, F.expr(f"pos div {size}").alias("segment"))
            .agg(listed("label"), F.first("n").alias("n"), F.first("unknown").alias("unknown"), *texts)
        )
    return union_all(one(with_texts(piece) if context else piece) for piece in sessions.pieces)


def replay_fold(sessions: Sessions, nets: Nets, expected: DataFrame, join,
                size: int = SEGMENT_EVENTS, share_variants: bool = False, share_prefixes: bool = False, context: bool = False) -> DataFrame:
    """Replay sessions that carry ``model_id`` and length ``n``; one result row per session.

    ``share_variants`` replays equal event lists once. It costs two more shuffles and pays
    off when sessions are short and repeat. ``share_prefixes`` also replays equal beginnings
    once, in a few rounds; it pays off where a step of the model costs much. ``context`` adds the events
    around missing tokens to the results.
    """
    labels, models = event_options(nets, expected)
    # one row per run, of which every task needs all
    models = F.broadcast(models)
    segments = label_segments(sessions, labels, size, join, context)
    short = segments.where(F.col("n") <= size)
    if share_prefixes:
        models = F.broadcast(cut_lineage(models))
    shares = share_variants or share_prefixes
    if sessions.total > COMPILE_FROM and not share_prefixes:
        models = _with_tables(models)
    folded = _fold_variants(short, models, share_prefixes) if shares else _fold_first(short.join(models, "model_id"))
    if context:
        folded = folded.withColumn("around", F.transform("miss", lambda code: F.get("around", F.floor(code / F.size("names")).cast("int"))))
    if sessions.longest <= size:
        return _finish(folded)
    columns = [*SESSION, "n", "unknown", "names", "final", "tok", "miss", "exploded", *(TEXTS if context else ())]
    longer = _with_all_missing(*_fold_long(segments.where(F.col("n") > size), models, size, sessions.longest), size, context)
    return _finish(folded.select(columns).unionByName(longer.select(columns)))


def _with_tables(models: DataFrame) -> DataFrame:
    """Models with the table of their automaton: ``after``, null where there is none."""
    models = F.broadcast(cut_lineage(models))
    rows = [(m, a.table(), a.labels) for m, a in compile_automata(models, fold_segment).items()]
    return F.broadcast(cut_lineage(models.join(F.broadcast(local_table(models.sparkSession, rows, "model_id string, after array<int>, n_labels int")), "model_id", "left")))


def _fold_first(rows: DataFrame) -> DataFrame:
    """Fold sessions of one segment. An automaton tells, a number an event, which of them explode; these need no markings."""
    opened = rows.withColumn("toks", F.array("init"))
    if "after" not in rows.columns:
        return _outcome(fold_segment(opened))
    last = F.aggregate("labels", F.lit(0), lambda s, label: F.when(s == EXPLODED, s).otherwise(F.get("after", s * F.col("n_labels") + label)))
    explodes = F.col("after").isNotNull() & (last == EXPLODED)
    given = opened.withColumn("explodes", explodes).withColumn("all_labels", F.col("labels"))
    folded = fold_segment(given.withColumn("labels", F.when(F.col("explodes"), F.array().cast("array<int>")).otherwise(F.col("all_labels"))))
    result = _outcome(folded)
    return result.withColumns({"exploded": F.col("exploded") | F.col("explodes"), "labels": F.col("all_labels")}).drop("all_labels", "explodes")


def _outcome(folded: DataFrame) -> DataFrame:
    return folded.withColumns({
        "tok": F.col("state.buf")[0]["tok"], "miss": missing_codes(F.col("state.buf")[0]["miss"]), "exploded": F.col("state.exploded")})


def _fold_variants(rows: DataFrame, models: DataFrame, prefixes: bool) -> DataFrame:
    variants = rows.select("model_id", "labels").distinct()
    if prefixes:
        results = _outcome(fold_tree(variants, models, _opening(F.array("init")), fold_part))
    else:
        results = _fold_first(variants.join(models, "model_id"))
    results = results.select("model_id", "labels", "tok", "miss", "exploded")
    # left without a hint: Spark sees the size of the results and splits a variant many sessions share
    return rows.join(results, ["model_id", "labels"]).join(models.select("model_id", "names", "final"), "model_id")


def _fold_long(segments: DataFrame, models: DataFrame, size: int, longest: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fold sessions of several segments, all segments at once: how each session ends, what each segment missed, and the segments.

    Where an automaton of the net tells what each segment starts from, they run once from there;
    otherwise they run stretch by stretch, from what the stretch before ends in.
    """
    # an unknown event cuts a session off: later segments do not count
    within = F.col("unknown").isNull() | (F.col("segment") <= F.expr(f"greatest(unknown.pos - 1, 0L) div {size}"))
    segments, models = cut_lineage(segments.where(within)), F.broadcast(cut_lineage(models))
    automata = compile_automata(models, fold_segment)
    # one row per run
    others = [row.model_id for row in models.select("model_id").collect() if row.model_id not in automata]
    ways = []
    if automata:
        ways.append(_fold_by_states(segments.where(F.col("model_id").isin(sorted(automata))), models, automata, -(-longest // size)))
    if others:
        ways.append(_fold_in_rounds(segments.where(F.col("model_id").isin(others)), models, size))
    runs, settled = (union_all(parts) for parts in zip(*ways))
    ends = (
        settled.groupBy(*SESSION)
        .agg(F.max_by("tok", "segment").alias("tok"), F.max("exploded").alias("exploded"))
        .join(segments.where("segment = 0").select(*SESSION, "n", "unknown"), SESSION)
        .join(models.select("model_id", "names", "final"), "model_id")
    )
    return ends, _pick_winners(runs, size), segments


def _with_all_missing(ends: DataFrame, missing: DataFrame, segments: DataFrame, size: int, context: bool) -> DataFrame:
    """Sessions with the list of their missing tokens, of all segments in one row."""
    lists, others = ["miss"], []
    if context:
        nth = lambda code: F.floor(code / F.col("width")).cast("bigint") - F.col("segment") * size
        missing = missing.join(segments.select(*SESSION, "segment", *TEXTS), [*SESSION, "segment"])
        missing = missing.withColumn("around", F.transform("miss", lambda code: F.get("around", nth(code).cast("int"))))
        lists, others = ["miss", "around"], TEXTS[1:]
    gathered = missing.groupBy(*SESSION).agg(
        F.sort_array(F.collect_list(F.struct("segment", *lists))).alias("all"), *[F.max(c).alias(c) for c in others])
    return ends.join(gathered, SESSION).withColumns({c: F.flatten(F.col("all")[c]) for c in lists})


def ledger_fold(sessions: Sessions, nets: Nets, expected: DataFrame, join, size: int = SEGMENT_EVENTS) -> DataFrame:
    """Missing and left tokens of each session as rows: (model_id, case_id, kind, at, place_id, tokens).

    A session of one segment is a row of bounded size; the missing tokens of a longer one stay with its segments.
    """
    labels, models = event_options(nets, expected)
    models = F.broadcast(models)
    segments = label_segments(sessions, labels, size, join)
    folded = _fold_first(segments.where(F.col("n") <= size).join(models, "model_id"))
    columns = [*SESSION, "n", "unknown", "names", "final", "tok", "miss", "exploded"]
    parts = [_ledger_rows(_finish(folded))]
    if sessions.longest > size:
        ends, missing, _ = _fold_long(segments.where(F.col("n") > size), models, size, sessions.longest)
        # what is missing at the end is found by _finish
        parts.append(_ledger_rows(_finish(ends.withColumn("miss", F.array().cast("array<bigint>")).select(columns))))
        whole = ends.where(~F.col("exploded") & F.col("unknown").isNull()).select(*SESSION, "names")
        parts.append(
            missing.join(whole, SESSION).select(*SESSION, F.size("names").alias("width"), "names", F.explode("miss").alias("code"))
            .select(*SESSION, F.lit("missing").alias("kind"), F.expr("code div width").alias("at"),
                    F.get("names", (F.col("code") % F.col("width")).cast("int")).alias("place_id")))
    # parts share no (kind, at) of a session, so each is counted where its sessions are
    return union_all(p.groupBy(*SESSION, "kind", "at", "place_id").agg(F.count(F.lit(1)).alias("tokens")) for p in parts)


def _ledger_rows(results: DataFrame) -> DataFrame:
    """Rows for the tokens in the lists of results, from one pass over them; failed checks have none."""
    row = lambda kind, at, place: F.struct(F.lit(kind).alias("kind"), at.alias("at"), place.alias("place_id"))
    rows = F.concat(
        F.zip_with("missing_tokens", "missing_indices", lambda p, at: row("missing", at, p)),
        F.transform("unconsumed_tokens", lambda p: row("left", F.col("session_length"), p)))
    return results.where(F.col("status") == STATUS_OK).select(*SESSION, F.inline(rows))


RUN = [*SESSION, "segment", "toks_out", "orgs", "misses"]


def _fold_by_states(segments: DataFrame, models: DataFrame, automata: dict[str, Automaton], most: int) -> tuple[DataFrame, DataFrame]:
    """Runs of all segments from their true starts, and their ends."""
    starts = start_states(segments, automata, SESSION, most)
    runs = _run(segments.join(starts, [*SESSION, "segment"]), models, watch=False)
    return runs.select(RUN), runs.select(*SESSION, "segment", F.col("toks_out")[0].alias("tok"), "exploded")


def _fold_in_rounds(segments: DataFrame, models: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Runs of all segments from their true starts, and their ends.

    A round folds the next stretch of segments of every session, one after the other in one row, from the truth; what follows an
    explosion is not folded. While sessions are too few to fill the task slots, the segments of a stretch first run at once
    from what the stretch starts from; where such a run holds for the true start it is taken over. Once fewer than half do, guesses end.
    """
    slots = task_slots(segments.sparkSession)
    front = segments.groupBy(*SESSION).agg(F.max("segment").alias("last")).join(
        models.select("model_id", F.array("init").alias("toks")), "model_id")
    front = cut_lineage(front)
    guesses = front.count() < slots
    done, width = 0, max(1, (FIRST_STRETCH if guesses else LAST_STRETCH) // size)
    parts = []
    while True:
        stretch = segments.where(F.col("segment").between(done, done + width - 1)).join(front, SESSION)
        if guesses:
            guessed = _run(stretch.where(F.col("segment") > done), models)
            guess = F.struct("toks", "toks_out", "orgs", "misses", "low", "exploded").cast(GUESS).alias("guess")
            stretch = stretch.join(guessed.select(*SESSION, "segment", guess), [*SESSION, "segment"], "left")
        else:
            stretch = stretch.withColumn("guess", F.lit(None).cast(GUESS))
        relayed = cut_lineage(_relay(stretch, models, slots))
        parts.append(relayed.select(*SESSION, F.inline("out")))
        done += width
        going = ~F.col("exploded") & (F.col("last") >= done)
        open_sessions, held, tried = relayed.agg(
            F.count_if(going), F.sum(F.size(F.filter("out", lambda o: o["held"]))), F.sum(F.size("out") - 1)).first()
        if not open_sessions:
            break
        front = relayed.where(going).select(*SESSION, "last", "toks")
        guesses = guesses and 2 * held >= tried
        width = max(1, (min(4 * width * size, LAST_STRETCH) if guesses else LAST_STRETCH) // size)
    runs = union_all(parts)
    return runs.select(RUN), runs.select(*SESSION, "segment", F.col("toks_out")[0].alias("tok"), "exploded")


def _relay(stretch: DataFrame, models: DataFrame, slots: int) -> DataFrame:
    """Fold the segments of each session in order, from the markings in ``toks``: ``out`` holds a run for each segment."""
    ordered = F.sort_array(F.collect_list(F.struct("segment", "labels", "guess")))  # LAST_STRETCH events at the most
    rows = (
        stretch.repartition(CHUNKS_PER_SLOT * slots, *SESSION)  # few sessions seldom meet in one task
        .groupBy(*SESSION).agg(ordered.alias("stretch"), F.first("toks").alias("toks"), F.first("last").alias("last"))
        .join(models, "model_id")
    )
    start = F.struct("toks", F.lit(False).alias("exploded"), F.array().cast(f"array<{RELAYED}>").alias("out")).cast(RELAY)
    end = F.aggregate("stretch", start, _relay_step)
    return rows.withColumn("end", end).select(*SESSION, "last", "end.*")


def _relay_step(state: Column, part: Column) -> Column:
    """The run of a segment, from its guess if that holds for the markings before it."""
    guess = part["guess"]
    gaps = F.zip_with(state["toks"], guess["toks"], lambda a, b: F.zip_with(a, b, lambda x, y: x - y))
    same_size = F.coalesce(F.size(state["toks"]) == F.size(guess["toks"]), F.lit(False))
    shift = F.when(same_size, bind(F.array_distinct(gaps), lambda g: F.when(F.size(g) == 1, g[0])))

    def next_state(shift: Column) -> Column:
        # places found empty are not shifted, and places found filled stay filled
        holds = F.forall(F.zip_with(shift, guess["low"], lambda d, low: (
            (low == NEVER_TESTED) | ((low == 0) & (d == 0)) | ((low > 0) & (d + low > 0)))), lambda x: x)
        moved = F.transform(guess["toks_out"], lambda tok: F.zip_with(tok, shift, lambda n, d: n + d))
        taken = F.struct(part["segment"], moved, guess["orgs"], guess["misses"], guess["exploded"], F.lit(True)).cast(RELAYED)
        fold = F.aggregate(part["labels"], _opening(state["toks"]), lambda s, label: _step(s, label, False))
        folded = bind(fold, lambda s: F.struct(
            part["segment"], s["buf"]["tok"], s["buf"]["org"], s["buf"]["miss"], s["exploded"], F.lit(False)).cast(RELAYED))
        run = F.when(F.coalesce(holds, F.lit(False)), taken).otherwise(folded)
        return bind(run, lambda r: F.struct(r["toks_out"], r["exploded"], F.concat(state["out"], F.array(r))).cast(RELAY))
    return F.when(state["exploded"], state).otherwise(bind(shift, next_state))


def _run(starts: DataFrame, models: DataFrame, watch: bool = True) -> DataFrame:
    """Fold segments from the markings in ``toks``.

    The segments are few bytes and much work, so they are spread over all task slots.
    """
    spread = starts.repartition(task_slots(starts.sparkSession), *SESSION, "segment")
    folded = fold_segment(spread.join(models, "model_id"), watch)
    return cut_lineage(folded.select(
        *SESSION, "segment", "toks", F.col("state.buf.tok").alias("toks_out"), F.col("state.buf.org").alias("orgs"),
        F.col("state.buf.miss").alias("misses"), F.col("state.low").alias("low"), F.col("state.exploded").alias("exploded")))


def _pick_winners(runs: DataFrame, size: int) -> DataFrame:
    """Per segment the missing tokens of the marking that ends up as the session's result.

    A segment knows which of its last markings wins once the markings after it all stem
    from one of them. Where they do not, the origins of 1, 2, 4, ... segments are chained.
    """
    key = [*SESSION, "segment"]
    origins = runs.select(*SESSION, (F.col("segment") - 1).alias("segment"), F.col("orgs").alias("chain"))
    known = lambda chain: F.when(F.size(F.array_distinct(chain)) == 1, F.coalesce(F.element_at(chain, 1), F.lit(0)))
    rows = (
        runs.select(*key).join(origins, key, "left")
        # the first marking of the last segment is the result
        .select(*key, F.coalesce("chain", F.array(F.lit(0))).alias("chain"))
        .withColumn("pick", known(F.col("chain")))
    )
    step = 1
    while True:
        rows = cut_lineage(rows)
        if rows.where("pick is null").isEmpty():
            break
        later = rows.select(*SESSION, (F.col("segment") - step).alias("segment"),
                            F.col("chain").alias("later_chain"), F.col("pick").alias("later_pick"))
        followed = F.transform("later_chain", lambda k: F.get("chain", k))
        rows = (
            rows.join(later, key, "left")
            .withColumn("chain", F.when(F.col("later_pick").isNotNull(), F.array(F.get("chain", F.col("later_pick"))))
                        .when(F.col("later_chain").isNotNull(), followed).otherwise(F.col("chain")))
            .withColumn("pick", F.coalesce("pick", known(F.col("chain"))))
            .select(*key, "chain", "pick")
        )
        step *= 2
    # codes count events from the start of the segment
    base = F.col("segment") * size * F.size(F.col("toks_out")[0])
    codes = F.transform(missing_codes(F.get("misses", F.col("pick"))), lambda code: code + base)
    return runs.join(rows, key).select(*key, F.size(F.col("toks_out")[0]).alias("width"), codes.alias("miss"))


def _finish(folded: DataFrame) -> DataFrame:
    """Consume the expected final marking and name places again."""
    consume = lambda tok, p: F.transform(tok, lambda n, k: F.when(k == p, n - 1).otherwise(n))
    note = lambda s, p: F.concat(s["miss"], F.array(F.col("n") * F.size("names") + p))
    ending = "struct<tok:array<int>,miss:array<bigint>>"
    settle = lambda s, p: F.when(
        F.get(s["tok"], p) > 0, F.struct(consume(s["tok"], p).alias("tok"), s["miss"].alias("miss")),
    ).otherwise(F.struct(s["tok"].alias("tok"), note(s, p).alias("miss"))).cast(ending)
    end = F.aggregate("final", F.struct("tok", "miss").cast(ending), settle)
    status = (F.when(F.col("exploded"), STATUS_PATH_EXPLOSION)
              .when(F.col("unknown").isNotNull(), STATUS_UNKNOWN_EVENT).otherwise(STATUS_OK))
    width = F.size("names")
    in_place = F.zip_with("names", F.col("end.tok"), lambda p, n: F.array_repeat(p, n))
    if_ok = lambda value, kind: F.when(F.col("status") == STATUS_OK, value).otherwise(F.array().cast(kind))
    context = []
    if "around" in folded.columns:
        at_end = F.array_repeat("around_end", F.size("end.miss") - F.size("miss"))
        texts = F.when(F.col("n") <= 2, F.array("short")).otherwise(if_ok(F.concat("around", at_end), "array<string>"))
        context = [texts.alias("surrounding_events")]
    return folded.withColumns({"end": end, "status": status}).select(
        "model_id", "case_id", "status",
        F.when(F.col("status") == STATUS_UNKNOWN_EVENT, F.col("unknown.event"))
         .when(F.col("status") == STATUS_PATH_EXPLOSION, F.lit(str(PATH_LIMIT))).alias("error_detail"),
        if_ok(F.transform(F.col("end.miss"), lambda m: F.get("names", (m % width).cast("int"))), "array<string>").alias("missing_tokens"),
        if_ok(F.transform(F.col("end.miss"), lambda m: F.floor(m / width)), "array<bigint>").alias("missing_indices"),
        if_ok(F.flatten(in_place), "array<string>").alias("unconsumed_tokens"),
        F.col("n").alias("session_length"),
        *context,
    )
