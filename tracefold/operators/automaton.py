"""Bounded nets as automata: the state a long session is in at the start of each of its segments.

After an event the markings of a session differ in their tokens alone, not in the number of missing ones. The
ordered list of their tokens is therefore all that the rest of the session depends on: a state. A net whose
states are few is compiled into a table from state and event to state, once for all sessions; the table grows
by what is reached from the states known so far. A segment of events is then a function over the states, a
short array, and functions are composed by a tree over the segments of a session, whatever its length.

Nets with more states than the limit get no automaton, nor do those whose places fill up without bound: a state
that has all the tokens of one on the way to it, and more, comes again with more still.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracefold.cluster import cut_lineage
from tracefold.local import local_table

STATE_LIMIT = 64
# jobs in which states are looked for, rows of a job, and events of a row
ROUND_LIMIT = 6
WORDS = 1 << 10
WORD_LIMIT = 12
# numbers in the tables of one model, and of all models together
CELL_LIMIT = 1 << 20
ALL_CELLS = 1 << 22
# segments whose functions are composed in one row
FAN = 64
EXPLODED = -1

Marking = tuple[int, ...]


@dataclass
class Automaton:
    """States as lists of markings, the start first, and the state after each label."""

    labels: int
    states: list[tuple[Marking, ...]] = field(default_factory=list)
    after: dict[tuple[int, int], int] = field(default_factory=dict)
    # the state each state was first reached from
    origin: dict[int, int] = field(default_factory=dict)

    # numbers of states, and states after words, found on the way
    numbers: dict[tuple[Marking, ...], int] = field(default_factory=dict)
    reached: dict[tuple[int, tuple[int, ...]], int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.numbers.update((s, k) for k, s in enumerate(self.states))

    def learn(self, start: int, word: tuple[int, ...], state: tuple[Marking, ...] | None) -> None:
        """Note what a word leads to (None: an explosion); shorter words of the same start come first."""
        before = self.reached.get((start, word[:-1]), start) if len(word) > 1 else start
        if before == EXPLODED:
            self.reached[start, word] = EXPLODED
            return
        if state is not None and state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.origin[len(self.states)] = before
            self.states.append(state)
        self.after[before, word[-1]] = self.reached[start, word] = EXPLODED if state is None else self.numbers[state]

    def unknown(self) -> list[int]:
        """States that were not yet followed."""
        return [s for s in range(len(self.states)) if (s, 0) not in self.after]

    def cells(self) -> int:
        return sum(len(m) for s in self.states for m in s) + len(self.states) * self.labels

    def grows(self, state: int) -> bool:
        """Whether the state holds more tokens than one before it, and nowhere fewer."""
        at, held = state, self.states[state]
        while at in self.origin:
            at = self.origin[at]
            old = self.states[at]
            if len(old) == len(held) and old != held and all(n >= o for new, marking in zip(held, old) for n, o in zip(new, marking)):
                return True
        return False

    def table(self) -> list[int]:
        """The state after state ``s`` and label ``l`` at ``s * labels + l``."""
        return [self.after[s, l] for s in range(len(self.states)) for l in range(self.labels)]


def _words(labels: int, states: int) -> list[list[int]]:
    """All words of labels, up to a length at which ``states`` of each make about WORDS rows."""
    words: list[list[int]] = [[label] for label in range(labels)]
    longest = words
    while len(longest) * labels * states <= WORDS and len(longest[0]) < WORD_LIMIT:
        longest = [[*word, label] for word in longest for label in range(labels)]
        words = words + longest
    return words


def compile_automata(models: DataFrame, fold: Callable[[DataFrame], DataFrame], limit: int = STATE_LIMIT) -> dict[str, Automaton]:
    """The automaton of each model (a row of ``models``) that has at most ``limit`` states.

    ``fold`` folds rows of ``labels`` from the markings in ``toks``. A round folds words of a few events from the
    states whose successors are unknown; a model leaves when it has too many states, so rounds are few.
    """
    spark = models.sparkSession
    # one row per run
    start = models.select("model_id", "init", F.size("options").alias("labels")).collect()
    automata = {r.model_id: Automaton(r.labels, [(tuple(r.init),)]) for r in start if 0 < r.labels * limit <= CELL_LIMIT}
    fresh = {m: [0] for m in automata}
    for _ in range(ROUND_LIMIT):
        if not fresh:
            break
        words = {m: _words(automata[m].labels, len(states)) for m, states in fresh.items()}
        rows = [(m, s, [list(marking) for marking in automata[m].states[s]]) for m, states in fresh.items() for s in states]
        frontier = local_table(spark, rows, "model_id string, from int, toks array<array<int>>")
        listed = local_table(spark, [(m, word) for m in words for word in words[m]], "model_id string, labels array<int>")
        stepped = fold(frontier.join(F.broadcast(listed), "model_id").join(F.broadcast(models), "model_id"))
        # markings after an explosion are of no account
        ends = F.when(~F.col("state.exploded"), F.col("state.buf.tok")).alias("toks")
        steps = cut_lineage(stepped.select("model_id", "from", "labels", ends).withColumn("state", F.when(F.col("toks").isNotNull(), F.md5(F.to_json(F.struct("toks"))))))
        found = steps.where("toks is not null").groupBy("model_id", "state").agg(F.first("toks").alias("toks"))
        sizes = {r.model_id: r for r in found.groupBy("model_id").agg(F.count("*").alias("states"), F.sum(F.size(F.flatten("toks"))).alias("cells")).collect()}
        small = [m for m in fresh if m not in sizes or (sizes[m].states <= limit and sizes[m].cells <= CELL_LIMIT)]
        # at most ``limit`` states a model, and a row for each word
        named = {(r.model_id, r.state): tuple(tuple(marking) for marking in r.toks) for r in found.where(F.col("model_id").isin(small)).collect()}
        reached = steps.where(F.col("model_id").isin(small)).select("model_id", "from", "labels", "state").collect()
        for r in sorted(reached, key=lambda r: (len(r.labels), r["from"], r.labels)):
            automata[r.model_id].learn(r["from"], tuple(r.labels), named.get((r.model_id, r.state)))
        automata = {m: a for m, a in automata.items() if m not in fresh or (
            m in small and len(a.states) <= limit and a.cells() <= CELL_LIMIT and not any(map(a.grows, range(len(a.states)))))}
        fresh = {m: a.unknown() for m, a in automata.items() if a.unknown()}
    kept: dict[str, Automaton] = {}
    for model in sorted(automata.keys() - fresh.keys(), key=lambda m: (automata[m].cells(), m)):
        if sum(a.cells() for a in kept.values()) + automata[model].cells() <= ALL_CELLS:
            kept[model] = automata[model]
    return kept


def start_states(segments: DataFrame, automata: dict[str, Automaton], session: list[str], most_segments: int) -> DataFrame:
    """``toks``, the markings at its start, for each segment (session, segment, labels); those after an explosion are left out."""
    spark = segments.sparkSession
    # bounded by ALL_CELLS
    tables = local_table(spark, [(m, a.table(), a.labels, len(a.states)) for m, a in automata.items()],
                         "model_id string, after array<int>, n_labels int, n_states int")
    states = local_table(spark, [(m, [[list(x) for x in s] for s in a.states]) for m, a in automata.items()],
                         "model_id string, states array<array<array<int>>>")
    run = F.aggregate("labels", F.sequence(F.lit(0), F.col("n_states") - 1), lambda reached, label: F.transform(
        reached, lambda s: F.when(s == EXPLODED, s).otherwise(F.get("after", s * F.col("n_labels") + label))))
    functions = cut_lineage(segments.join(F.broadcast(tables), "model_id").select(*session, F.col("segment").alias("at"), run.alias("f")))
    starts = _scan(functions, session, most_segments)
    return (
        starts.where(F.col("start") != EXPLODED).join(F.broadcast(states), "model_id")
        .select(*session, F.col("at").alias("segment"), F.get("states", F.col("start")).alias("toks"))
    )


def _apply(f, state):
    return F.when(state == EXPLODED, state).otherwise(F.get(f, state))


def _scan(functions: DataFrame, session: list[str], most: int) -> DataFrame:
    """``start``, the state before each function ``f`` (session, at), from state 0 on; ``most`` is an upper bound of their number.

    Functions are composed in rows of FAN, these rows again, up to one for each session; states come back the same way.
    """
    up = F.expr(f"at div {FAN}")
    ordered = F.sort_array(F.collect_list(F.struct("at", "f")))  # FAN functions at the most
    blocks = functions.groupBy(*session, up.alias("up")).agg(ordered.alias("b"))
    if most <= FAN:
        begun = blocks.withColumn("start", F.lit(0))
    else:
        whole = F.aggregate(F.col("b.f"), F.transform(F.col("b.f")[0], lambda _, k: k), lambda done, f: F.transform(done, lambda s: _apply(f, s)))
        above = _scan(blocks.select(*session, F.col("up").alias("at"), whole.alias("f")), session, -(-most // FAN))
        begun = blocks.join(above.withColumnRenamed("at", "up"), [*session, "up"])
    reached = F.aggregate(F.col("b.f"), F.array("start"), lambda done, f: F.concat(done, F.array(_apply(f, F.element_at(done, -1)))))
    return begun.withColumn("reached", reached).select(*session, F.posexplode("b.at").alias("k", "at"), "reached").select(
        *session, "at", F.get("reached", F.col("k")).alias("start"))
