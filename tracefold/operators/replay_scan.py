"""Replay on models where every event name has one transition.

Without a choice of transition the places do not influence each other, so replay is
arithmetic per session and place. With ``c`` and ``o`` the tokens an event consumes
from and produces in a place, and ``init`` the tokens before the first event,

    debt(i)    = sum of c up to i  -  sum of o before i  -  init
    created(i) = max(0, greatest debt up to i)

is the number of tokens that had to be made up, so the event at i misses
``created(i) - created(i-1)``. Both are running window frames. They also compose over
chunks of a session: a chunk is summed up by its net effect and its greatest debt, and
the tokens it starts from follow from the chunks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracefold.operators.context import TEXTS, with_texts
from tracefold.operators.models import Nets, directed_arcs
from tracefold.operators.sessions import Piece, Sessions, union_all, with_session_values
from tracefold.schemas import STATUS_OK, STATUS_UNKNOWN_EVENT

EFFECTS = "array<struct<place_id:string,c:int,o:int,ord:int,init:int>>"


def event_effects(nets: Nets, expected: DataFrame) -> DataFrame:
    """Per (model_id, event): ``effects``, what the event's only transition does to each place.

    Each row also holds ``closing``, what the end of a session does in that model.
    """
    is_input = F.col("side") == "in"
    inits = nets.places.select("model_id", "place_id", F.col("init_tokens").alias("init"))
    touched = (
        directed_arcs(nets)
        .groupBy("model_id", "transition_id", "place_id")
        .agg(F.max(is_input.cast("int")).alias("c"), F.max((~is_input).cast("int")).alias("o"),
             F.min(F.when(is_input, F.col("arc_ord"))).alias("ord"))
        .join(inits, ["model_id", "place_id"], "left")
        .withColumns({"ord": F.coalesce("ord", F.lit(-1)), "init": F.coalesce("init", F.lit(0))})
    )
    effect = F.when(F.col("place_id").isNotNull(), F.struct("place_id", "c", "o", "ord", "init"))
    return (
        nets.transitions.join(touched, ["model_id", "transition_id"], "left")
        .groupBy("model_id", F.col("name").alias("event"))
        .agg(F.collect_list(effect).cast(EFFECTS).alias("effects"))
        .join(_closing_effects(nets, expected), "model_id", "left")
        .withColumn("closing", F.coalesce("closing", F.array().cast(EFFECTS)))
    )


def _closing_effects(nets: Nets, expected: DataFrame) -> DataFrame:
    """Per model: the expected final marking as consumption, and initial places left untouched.

    ``expected`` holds (model_id, expected_final); a place listed k times is consumed k times.
    """
    inits = nets.places.select("model_id", "place_id", F.col("init_tokens").alias("init"))
    consumed = (
        expected.select("model_id", F.posexplode("expected_final").alias("ord", "place_id"))
        .join(inits, ["model_id", "place_id"], "left")
        .select("model_id", "place_id", F.lit(1).alias("c"), "ord", F.coalesce("init", F.lit(0)).alias("init"))
    )
    untouched = inits.where("init > 0").select("model_id", "place_id", F.lit(0).alias("c"), F.lit(-1).alias("ord"), "init")
    return (
        consumed.unionByName(untouched)
        .groupBy("model_id")
        .agg(F.collect_list(F.struct("place_id", "c", F.lit(0).alias("o"), "ord", "init")).cast(EFFECTS).alias("closing"))
    )


def replay_scan(sessions: Sessions, nets: Nets, expected: DataFrame, join, counts: bool = False, context: bool = False) -> DataFrame:
    """Replay sessions that carry ``model_id`` and length ``n``; one result row per session.

    ``join`` joins log rows with a table per event name. ``counts`` only counts tokens, which needs
    no lists however long a session is. ``context`` adds the events around missing tokens to the results.
    """
    effects = event_effects(nets, expected)
    sessions = sessions.map(with_texts) if context else sessions
    finish = _count_results if counts else _collect_results
    return union_all(finish(_replay_piece(piece, effects, join)) for piece in sessions.pieces)


def _replay_piece(piece: Piece, effects: DataFrame, join) -> Piece:
    rows = join(piece.rows, effects, ["model_id", "event"], "left")
    unknown = F.min(F.when(F.col("effects").isNull(), F.struct("pos", "event")))
    known = with_session_values(piece.with_rows(rows), unknown=unknown)
    return _fire(_token_steps(known))


def _token_steps(piece: Piece) -> Piece:
    """One row per event and touched place; a session with an unknown event keeps a single row."""
    last = F.col("pos") == F.col("n") - 1
    texts = [c for c in TEXTS if c in piece.rows.columns]
    around = lambda text: [F.col(text).alias("around")] if texts else []
    at = lambda name, pos, text: F.transform(name, lambda e: F.struct(pos.alias("at"), *around(text), e.alias("effect")))
    all_effects = F.concat(
        at("effects", F.col("pos"), "around"),
        F.when(last, at("closing", F.col("n"), "around_end")).otherwise(F.array()),
    )
    rows = (
        piece.rows.where(F.col("unknown").isNull() | (F.col("pos") == 0))
        .select(*dict.fromkeys(["model_id", *piece.task_keys]), "n", "unknown", *texts[2:],
                F.explode_outer(F.when(F.col("unknown").isNull(), all_effects)).alias("step"))
        .select("*", "step.at", *["step.around" for _ in texts[:1]], "step.effect.*").drop("step")
    )
    return piece.with_rows(rows)


def _fire(piece: Piece) -> Piece:
    """Add ``made_up``, the tokens missing at each step."""
    rows = piece.rows
    in_place = Window.partitionBy(*piece.task_keys, "place_id").orderBy("at", "ord")
    up_to_here = in_place.rowsBetween(Window.unboundedPreceding, 0)
    before_here = in_place.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("debt", F.sum(F.col("c") - F.col("o")).over(up_to_here) + F.col("o"))
    if piece.split:
        rows = rows.join(_tokens_at_chunk_start(rows, piece.keys), [*piece.task_keys, "place_id"], "left")
    else:
        rows = rows.withColumn("held", F.col("init"))
    created = lambda frame: F.greatest(F.lit(0), F.coalesce(F.max(F.col("debt") - F.col("held")).over(frame), F.lit(0)))
    return piece.with_rows(rows.withColumn("made_up", created(up_to_here) - created(before_here)))


def _tokens_at_chunk_start(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Tokens each place holds when a chunk begins: one row per chunk and place it touches.

    A chunk turns t tokens into max(t, need) + net. Unrolled over the chunks before it,
    with S the sum of their nets, that is S + max(init, greatest (need - S)).
    """
    chunks = rows.where(F.col("place_id").isNotNull()).groupBy(*keys, "chunk", "place_id").agg(
        F.sum(F.col("o") - F.col("c")).alias("net"), F.max("debt").alias("need"), F.max("init").alias("init"))
    before = Window.partitionBy(*keys, "place_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    summed = chunks.withColumn("net_before", F.coalesce(F.sum("net").over(before), F.lit(0)))
    deepest = F.max(F.col("need") - F.col("net_before")).over(before)
    return summed.select(
        *keys, "chunk", "place_id",
        (F.col("net_before") + F.greatest(F.col("init"), F.coalesce(deepest, F.col("init")))).alias("held"))


# carried along with a session; grouping by the keys alone keeps the order of the windows
CARRIED = ("model_id", "n", "unknown")


def _carried(piece: Piece) -> list[Column]:
    # the text of a short session stands on its first event
    short = [F.max("short").alias("short")] if "short" in piece.rows.columns else []
    return [F.first(c).alias(c) for c in CARRIED if c not in piece.keys] + short


def _outcome_columns() -> list[Column]:
    failed = F.col("unknown").isNotNull()
    return [
        F.col("model_id"), F.col("case_id"),
        F.when(failed, STATUS_UNKNOWN_EVENT).otherwise(STATUS_OK).alias("status"),
        F.col("unknown.event").alias("error_detail"),
    ]


def _per_place(piece: Piece, **extra: Column) -> DataFrame:
    """One row per session and place with the tokens left at the end."""
    left = F.max("init") + F.sum(F.col("o") - F.col("c") + F.col("made_up"))
    return piece.rows.groupBy(*piece.keys, "place_id").agg(
        *_carried(piece), left.alias("left"), *[value.alias(name) for name, value in extra.items()])


def _count_results(piece: Piece) -> DataFrame:
    per_session = _per_place(piece, made_up=F.sum("made_up")).groupBy(*piece.keys).agg(
        *_carried(piece), F.coalesce(F.sum("made_up"), F.lit(0)).alias("missing"), F.coalesce(F.sum("left"), F.lit(0)).alias("left"))
    return per_session.select(
        *_outcome_columns(), F.col("missing").alias("missing_count"), F.col("left").alias("unconsumed_count"),
        F.col("n").alias("session_length"))


def _collect_results(piece: Piece) -> DataFrame:
    context = "around" in piece.rows.columns
    missing = F.when(F.col("made_up") > 0, F.struct("at", "ord", "place_id", *(["around"] if context else [])))
    left = F.when(F.col("left") > 0, F.struct("place_id", "left"))
    per_session = _per_place(piece, missing=F.collect_list(missing)).groupBy(*piece.keys).agg(
        *_carried(piece),
        F.array_sort(F.flatten(F.collect_list("missing"))).alias("missing"),
        F.array_sort(F.collect_list(left)).alias("left"))
    return per_session.select(
        *_outcome_columns(),
        F.col("missing.place_id").alias("missing_tokens"),
        F.col("missing.at").alias("missing_indices"),
        repeat_tokens(F.col("left")).alias("unconsumed_tokens"),
        F.col("n").alias("session_length"),
        *([F.when(F.col("n") <= 2, F.array("short")).otherwise(F.col("missing.around")).alias("surrounding_events")] if context else []),
    )


def ledger_scan(sessions: Sessions, nets: Nets, expected: DataFrame, join) -> DataFrame:
    """Missing and left tokens of each session as rows: (model_id, case_id, kind, at, place_id, tokens)."""
    effects = event_effects(nets, expected)
    return union_all(_ledger(_replay_piece(piece, effects, join)) for piece in sessions.pieces)


def _ledger(piece: Piece) -> DataFrame:
    # steps are used twice; a session is not gathered for either
    steps = piece.rows.where(F.col("unknown").isNull() & F.col("place_id").isNotNull())
    missing = steps.where("made_up > 0").groupBy("model_id", "case_id", "at", "place_id").agg(F.sum("made_up").alias("tokens"))
    left = _per_place(piece.with_rows(steps)).where("left > 0")
    return (
        missing.select("model_id", "case_id", F.lit("missing").alias("kind"), "at", "place_id", "tokens")
        .unionByName(left.select("model_id", "case_id", F.lit("left").alias("kind"), F.col("n").alias("at"), "place_id", F.col("left").alias("tokens")))
    )


def repeat_tokens(counted: Column) -> Column:
    """Counted places, in order, as one entry per token."""
    return F.flatten(F.transform(counted, lambda p: F.array_repeat(p["place_id"], p["left"].cast("int"))))
