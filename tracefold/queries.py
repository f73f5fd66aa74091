"""Queries over the test tables, one per operator; ``oracles`` holds the same questions as SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracefold.cluster import shared_path, task_slots
from tracefold.demo import FIRST_EVENTS, LAST_EVENTS, NETS
from tracefold.local import local_table, nets_from_rows
from tracefold.operators import edits as E
from tracefold.operators import models as M
from tracefold.operators import sessions as S
from tracefold.plans import check as C
from tracefold.plans import ledger as L
from tracefold.plans import report as R
from tracefold.schemas import STATUS_PATH_EXPLOSION, STATUS_UNKNOWN_EVENT
from tracefold.sources.delimited import join_line, read_delimited, split_line
from tracefold.sources.pnml import read_models

AS_OF = "2024-02-01"
# a row becomes places, transitions and arcs with names
LINES_PER_TASK = 200_000
RAW_FIELDS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- logs and models ---------------------------------------------------------------


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a user as one case."""
    return S.extract_event_log(table(spark, sf_dir, "events"), "user_id", "ts", "event_type")


def day_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a user on one day as a case."""
    day = F.concat_ws("@", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    return S.extract_event_log(table(spark, sf_dir, "events"), day, "ts", "event_type")


def shard_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A twentieth of all events as one case: long sessions."""
    return S.extract_event_log(table(spark, sf_dir, "events"), F.col("user_id") % 20, "ts", "event_type")


def quarter_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all events as one case: sessions longer than a segment."""
    return S.extract_event_log(table(spark, sf_dir, "events"), F.col("user_id") % 4, "ts", "event_type")


def hour_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a user within an hour as a case: many of one or two events."""
    hour = F.concat_ws("@", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH"))
    return S.extract_event_log(table(spark, sf_dir, "events"), hour, "ts", "event_type")


def chat_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation as a case, its turns in order."""
    return S.extract_event_log(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


def demo_nets(spark: SparkSession) -> M.Nets:
    return nets_from_rows(spark, NETS)


def order_nets(spark: SparkSession, sf_dir: str) -> M.Nets:
    """One net per order: a transition per line number, places by supplier and part.

    Repeated line numbers give repeated arcs, untaxed lines arcs from a foreign element.
    """
    lines = table(spark, sf_dir, "lineitem").withColumns({
        "model_id": F.col("l_orderkey").cast("string"), "line": F.col("l_linenumber").cast("int"),
        "transition_id": F.concat(F.lit("t"), "l_linenumber"), "supp": F.col("l_suppkey") % 10, "part": F.col("l_partkey") % 10})
    transitions = (
        lines.groupBy("model_id", F.col("line").alias("trans_ord"), "transition_id")
        .agg(F.char(F.min(F.ascii("l_returnflag"))).alias("name"))
    )
    kind = F.when(F.col("l_tax") == 0, "s").otherwise("p")
    inputs = lines.where("l_linestatus = 'O'").select(
        "model_id", (F.col("line") * 2).alias("arc_ord"), F.concat(kind, "supp").alias("source"),
        F.col("transition_id").alias("target"))
    outputs = lines.where("l_discount > 0.02").select(
        "model_id", (F.col("line") * 2 + 1).alias("arc_ord"), F.col("transition_id").alias("source"),
        F.concat(F.lit("p"), "part").alias("target"))
    marked = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    ends = F.array(F.struct(F.col("supp").alias("k"), marked.alias("init")), F.struct(F.col("part").alias("k"), F.lit(0).alias("init")))
    places = (
        lines.select("model_id", F.inline(ends))
        .groupBy("model_id", F.col("k").cast("int").alias("place_ord")).agg(F.max("init").alias("init_tokens"))
        .select("model_id", F.concat(F.lit("order-"), "model_id", F.lit(".pnml")).alias("model_file"), "place_ord",
                F.concat(F.lit("p"), "place_ord").alias("place_id"), F.concat(F.lit("place "), "place_ord").alias("name"),
                "init_tokens")
    )
    return M.Nets(places, transitions.select("model_id", "trans_ord", "transition_id", "name"), inputs.unionByName(outputs))


def order_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nets of ``order_nets`` as a row for each model, from one scan and one shuffle of the lines."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("model_id"), F.struct(
            F.col("l_linenumber").cast("int").alias("line"), F.ascii("l_returnflag").alias("flag"),
            (F.col("l_suppkey") % 10).cast("int").alias("supp"), (F.col("l_partkey") % 10).cast("int").alias("part"),
            F.when(F.col("l_tax") == 0, "s").otherwise("p").alias("kind"), (F.col("l_returnflag") == "R").cast("int").alias("marked"),
            (F.col("l_linestatus") == "O").alias("in"), (F.col("l_discount") > 0.02).alias("out")).alias("l"))
    # dealt by order to as many tasks as there are rows for: merged by the bytes of the lines, tasks would hold too many models
    n_lines = lines.count()
    if n_lines > LINES_PER_TASK:
        lines = lines.repartition(max(task_slots(spark), -(-n_lines // LINES_PER_TASK)), "model_id")
    # the lines of an order: a few rows of numbers
    orders = lines.groupBy("model_id").agg(F.sort_array(F.collect_list("l")).alias("ls"))
    first_of = lambda rows, key: F.filter(rows, lambda r, k: (k == 0) | (F.get(rows, k - 1)[key] != r[key]))
    ends = F.sort_array(F.concat(
        F.transform("ls", lambda l: F.struct(l["supp"].alias("k"), (-l["marked"]).alias("less"))),
        F.transform("ls", lambda l: F.struct(l["part"].alias("k"), F.lit(0).alias("less")))))
    orders = orders.withColumn("ends", ends)
    named = lambda letter, c: F.concat(letter if isinstance(letter, Column) else F.lit(letter), c.cast("string"))
    file = F.concat(F.lit("order-"), "model_id", F.lit(".pnml"))
    places = F.transform(first_of(F.col("ends"), "k"), lambda e: F.struct(e["k"], named("p", e["k"]), named("place ", e["k"]), -e["less"], file))
    transitions = F.transform(first_of(F.col("ls"), "line"), lambda l: F.struct(l["line"], named("t", l["line"]), F.char(l["flag"])))
    arcs = F.sort_array(F.concat(
        F.transform(F.filter("ls", lambda l: l["in"]), lambda l: F.struct(
            (l["line"] * 2).alias("arc_ord"), named(l["kind"], l["supp"]).alias("source"), named("t", l["line"]).alias("target"))),
        F.transform(F.filter("ls", lambda l: l["out"]), lambda l: F.struct(
            (l["line"] * 2 + 1).alias("arc_ord"), named("t", l["line"]).alias("source"), named("p", l["part"]).alias("target")))))
    return orders.select("model_id", *[v.cast(E.LIST[c]).alias(c) for c, v in (("places", places), ("transitions", transitions), ("arcs", arcs))])


def shop(model: str = "shop", area: str = "shop", expected: tuple[str, ...] = ("p2",)) -> C.Run:
    return C.Run(model, area, FIRST_EVENTS, LAST_EVENTS, expected)


def flat(results: DataFrame) -> DataFrame:
    """Check results with their lists as comma-separated text."""
    text = lambda name: F.array_join(F.col(name).cast("array<string>"), ",").alias(name)
    lists = {"missing_tokens", "missing_indices", "unconsumed_tokens"}
    columns = [text(c) if c in lists else F.col(c) for c in results.columns if c != "surrounding_events"]
    if "surrounding_events" in results.columns:
        columns.append(F.array_join("surrounding_events", ";").alias("surrounding_events"))
    return results.select(*columns).withColumn("error_detail", F.coalesce("error_detail", F.lit("")))


# --- scans and sessions ------------------------------------------------------------


def delimited_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("user_id").cast("string"), "event_type", F.col("value").cast("decimal(18,2)").cast("string").alias("value"), "props")
    lines = events.na.fill("").select(split_line(join_line(RAW_FIELDS)).alias("fields"))
    return lines.select(*[F.col("fields")[k].alias(name) for k, name in enumerate(RAW_FIELDS)], F.size("fields").alias("n_fields"))


def extract_event_log(spark, sf_dir):
    log = S.extract_event_log(table(spark, sf_dir, "events"), 2, 1, 3)
    return log.select("case_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event")


def _grouped(sessions: S.Sessions) -> DataFrame:
    times = F.transform("timestamps", lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return S.group_sessions(sessions).select(
        "case_id", "segment", F.array_join(times, ",").alias("timestamps"), F.array_join("events", ",").alias("events"))


def group_sessions(spark, sf_dir):
    return _grouped(S.order_events(user_log(spark, sf_dir)))


def sort_sessions(spark, sf_dir):
    return S.order_events(user_log(spark, sf_dir)).rows("pos", "event")


def sessions_with_start(spark, sf_dir):
    return S.sessions_with_start(S.order_events(day_log(spark, sf_dir)), FIRST_EVENTS).rows("pos", "event")


def trim_start(spark, sf_dir):
    return S.trim_start(S.order_events(day_log(spark, sf_dir)), FIRST_EVENTS).rows("pos", "event")


def complete_sessions(spark, sf_dir):
    return S.complete_sessions(S.order_events(day_log(spark, sf_dir)), FIRST_EVENTS, LAST_EVENTS).rows("pos", "event")


def trim_end(spark, sf_dir):
    return S.trim_end(S.order_events(day_log(spark, sf_dir)), LAST_EVENTS).rows("pos", "event")


def trim_sessions(spark, sf_dir):
    return S.trim_sessions(S.order_events(day_log(spark, sf_dir)), FIRST_EVENTS, LAST_EVENTS).rows("pos", "event")


def extract_logs(spark, sf_dir):
    return _grouped(S.extract_logs(user_log(spark, sf_dir), FIRST_EVENTS, LAST_EVENTS))


def session_length(spark, sf_dir):
    return S.session_lengths(S.extract_logs(day_log(spark, sf_dir), FIRST_EVENTS, LAST_EVENTS))


# --- model tables ------------------------------------------------------------------


def model_places(spark, sf_dir):
    nets = order_nets(spark, sf_dir)
    end = nets.transitions.select("model_id").distinct().select(
        "model_id", F.concat(F.lit("order-"), "model_id", F.lit(".pnml")).alias("model_file"), F.lit(0).alias("place_ord"),
        F.lit("p100").alias("place_id"), F.lit("end").alias("name"), F.lit(0).alias("init_tokens"))
    return M.add_places(nets, end).places


def _with_closing_transition(nets: M.Nets) -> M.Nets:
    added = nets.transitions.select("model_id").distinct().select(
        "model_id", F.lit(0).alias("trans_ord"), F.lit("t100").alias("transition_id"), F.lit("A").alias("name"),
        F.array(F.lit("p1"), F.lit("p2")).alias("input_places"), F.array(F.lit("p100")).alias("output_places"))
    return M.add_transitions(nets, added)


def model_transition_lookup(spark, sf_dir):
    return M.transition_lookup(_with_closing_transition(order_nets(spark, sf_dir)))


def _edited(models: DataFrame, edits: Column) -> M.Nets:
    """Models after edits that follow from their own rows."""
    return E.nets_of_rows(E.fold_edits(models.withColumn("edits", edits)))


def model_arcs(spark, sf_dir):
    closing = E.edit("add_transition", 1, id=F.lit("t100"), name=F.lit("A"), inputs=F.array(F.lit("p1"), F.lit("p2")), outputs=F.array(F.lit("p100")))
    return M.transition_arcs(_edited(order_models(spark, sf_dir), F.array(closing)))


def model_initial_marking(spark, sf_dir):
    return M.initial_marking(order_nets(spark, sf_dir))


def _nation_files(spark, sf_dir, path: str) -> None:
    """A model file per nation: a place per order status, a transition per priority, an arc for each pair of them."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    # a nation has a few statuses and priorities, whatever its orders
    pairs = (
        orders.select(F.col("c_nationkey").alias("model"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("t"))
        .groupBy("model", "s", "t").agg(F.count("*").alias("n")).withColumn("nr", F.substring("t", 1, 1))
    )
    marking = F.when(F.col("s") == "O", "<initialMarking/>").when(F.col("s") == "F", "<initialMarking><text>0</text></initialMarking>").otherwise("")
    parts = [
        pairs.select("model", F.lit("0").alias("at"), F.lit("<?xml version='1.0'?><pnml><net id='first'>").alias("line")),
        pairs.select("model", F.concat(F.lit("1"), "s"), F.format_string("  <place id='p%s'><name><text> status %s </text></name>%s</place>", "s", "s", marking)),
        pairs.select("model", F.concat(F.lit("2"), "t"), F.format_string("  <transition id='t%s'><name><text>%s</text></name></transition>", "nr", "t")),
        pairs.select("model", F.concat(F.lit("3"), "s", "t"), F.when(F.col("n") % 2 == 0, F.format_string("  <arc id='a' source='p%s' target='t%s'/>", "s", "nr"))
                     .otherwise(F.format_string("  <arc id='a' source='t%s' target='p%s'/>", "nr", "s"))),
        pairs.select("model", F.lit("4"), F.lit("</net><net id='second'><place id='p9'><name><text>not read</text></name></place></net></pnml>")),
    ]
    lines = reduce(DataFrame.union, parts).distinct()
    lines.repartition("model").sortWithinPartitions("model", "at").select("model", "line").write.partitionBy("model").text(path)


def model_scan(spark, sf_dir):
    """Places, transitions and arcs of model files written from the orders."""
    path = shared_path(spark, "models")
    _nation_files(spark, sf_dir, path)
    nets = read_models(spark, path, F.regexp_extract("file_path", "model=([0-9]+)", 1))
    none = F.lit("")
    return (
        nets.places.select("model_id", F.lit("place").alias("kind"), F.col("place_ord").alias("ord"), F.col("place_id").alias("id"), "name",
                           F.col("init_tokens").cast("string").alias("more"))
        .union(nets.transitions.select("model_id", F.lit("transition"), "trans_ord", "transition_id", "name", none))
        .union(nets.arcs.select("model_id", F.lit("arc"), "arc_ord", "source", none, "target"))
    )


def _net_rows(nets: DataFrame) -> DataFrame:
    """Each transition of model rows with the places on its sides, a transition without any once."""
    kind = lambda a: F.substring(a["source"], 1, 1)
    parts = F.concat(
        F.transform("transitions", lambda t: F.struct(t["transition_id"].alias("transition_id"), t["name"].alias("name"), F.lit(None).cast("string").alias("side"),
                                                      F.lit(None).cast("string").alias("place_id"))),
        F.transform(F.filter("arcs", lambda a: kind(a).isin("p", "t")), lambda a: F.struct(
            F.when(kind(a) == "p", a["target"]).otherwise(a["source"]).alias("transition_id"), F.lit(None).cast("string").alias("name"),
            F.when(kind(a) == "p", "in").otherwise("out").alias("side"), F.when(kind(a) == "p", a["source"]).otherwise(a["target"]).alias("place_id"))))
    ends = F.collect_set(F.when(F.col("side").isNotNull(), F.struct("side", "place_id")))
    rows = (
        nets.select("model_id", parts.alias("parts")).select("model_id", F.inline_outer("parts"))
        .groupBy("model_id", "transition_id").agg(F.max("name").alias("name"), ends.alias("ends")).where(F.col("name").isNotNull())
    )
    return rows.select("model_id", "transition_id", "name", F.inline_outer("ends")).na.fill("", ["side", "place_id"])


def model_delete_transition(spark, sf_dir):
    dropped = F.filter("transitions", lambda t: t["name"] == "N")
    edits = F.transform(dropped, lambda t: E.edit("delete_transition", 1, id=t["transition_id"]))
    return _net_rows(E.fold_edits(order_models(spark, sf_dir).withColumn("edits", edits)))


def model_merge_transitions(spark, sf_dir):
    """The first transition of each model gets the places of its last."""
    first, last = (F.col("transitions")[k]["transition_id"] for k in (F.lit(0), F.size("transitions") - 1))
    merge = F.filter(F.array(E.edit("merge", 1, id=first, other=last)), lambda e: e["id"] != e["other"])
    return M.transition_arcs(_edited(order_models(spark, sf_dir), merge))


def model_edit_log(spark, sf_dir):
    """All kinds of edits, given as rows for each order, applied in the order of their numbers."""
    status, priority = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    p100, t1 = F.lit("p100"), F.lit("t1")
    log = F.array(
        F.when(status == "O", E.edit("merge", 0, id=F.lit("t2"), other=F.lit("t3"))),
        F.when(priority == "1", E.edit("add_transition", 1, id=F.lit("t100"), name=F.lit("A"), inputs=F.array(F.lit("p1"), F.lit("p2")), outputs=F.array(p100))),
        F.when(status == "F", E.edit("delete_transition", 2, id=t1)),
        F.when(priority.isin("1", "2"), E.edit("suffix", 3, name=F.lit("b"))),
        E.edit("add_place", 4, id=p100, name=F.lit("end")),
        F.when(priority == "2", E.edit("add_arc", 5, id=p100, other=t1)))
    edits = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("model_id"), F.inline(F.filter(log, lambda e: e.isNotNull())))
    nets = E.fold_edits(E.with_edits(order_models(spark, sf_dir), edits))
    elements = F.concat(
        F.transform("places", lambda r: F.struct(F.lit("place").alias("kind"), r["place_ord"].alias("ord"), r["place_id"].alias("id"), r["name"].alias("more"))),
        F.transform("transitions", lambda r: F.struct(F.lit("transition").alias("kind"), r["trans_ord"].alias("ord"), r["transition_id"].alias("id"), r["name"].alias("more"))),
        F.transform("arcs", lambda r: F.struct(F.lit("arc").alias("kind"), r["arc_ord"].alias("ord"), r["source"].alias("id"), r["target"].alias("more"))))
    return nets.select("model_id", F.inline(elements))


def model_suffix_ids(spark, sf_dir):
    nets = M.suffix_ids(order_nets(spark, sf_dir), "b")
    return M.transition_arcs(nets).join(
        nets.places.select("model_id", "place_id", "init_tokens"), ["model_id", "place_id"])


def model_input_transitions(spark, sf_dir):
    return M.input_transitions(order_nets(spark, sf_dir))


def model_output_transitions(spark, sf_dir):
    return M.output_transitions(order_nets(spark, sf_dir))


def event_transition_lookup(spark, sf_dir):
    return M.event_transition_lookup(user_log(spark, sf_dir), demo_nets(spark), "shop_amb").select(
        "case_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event", "transition_id", "trans_ord")


def _day_markings(spark, sf_dir) -> DataFrame:
    """Per user-day and kind of event in it: a marking with a token per event, spread over six places."""
    place = F.concat(F.lit("p"), F.col("event_id") % 6 + 1)
    marking = F.concat_ws("@", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    rows = table(spark, sf_dir, "events").select(marking.alias("marking_id"), F.col("event_type").alias("event"), place.alias("place"))
    # at most six places per marking, whatever its number of events
    tokens = rows.groupBy("marking_id").agg(F.collect_set("place").alias("tokens"))
    return tokens.join(rows.select("marking_id", "event").distinct(), "marking_id").withColumn("model_id", F.lit("shop_amb"))


def transition_missing_ratio(spark, sf_dir):
    nets = demo_nets(spark)
    return M.missing_ratios(_day_markings(spark, sf_dir), nets).drop("model_id", "trans_ord")


def least_missing_transitions(spark, sf_dir):
    nets = demo_nets(spark)
    return M.least_missing_transitions(_day_markings(spark, sf_dir), nets).drop("model_id", "trans_ord")


# --- replay ------------------------------------------------------------------------


def _check(spark, log: DataFrame, *runs: C.Run, **options) -> DataFrame:
    return flat(C.check_logs(S.order_events(log), demo_nets(spark), runs, **options)).drop("model_id")


def replay_deterministic(spark, sf_dir):
    return _check(spark, user_log(spark, sf_dir), shop(expected=()), method="scan")


def final_marking(spark, sf_dir):
    return _check(spark, day_log(spark, sf_dir), shop(expected=("p2", "p5", "p2")), method="scan")


def check_logs(spark, sf_dir):
    return _check(spark, day_log(spark, sf_dir), shop("shop_noerror"))


def replay_ambiguous(spark, sf_dir):
    return _check(spark, chat_log(spark, sf_dir), C.Run("chat", expected_final=()))


def check_logs_ambiguous(spark, sf_dir):
    return _check(spark, day_log(spark, sf_dir), shop("shop_amb"), share_variants=True)


def replay_path_explosion(spark, sf_dir):
    return _check(spark, user_log(spark, sf_dir), C.Run("explode", expected_final=("p1",)))


def conformance_multi_model(spark, sf_dir):
    runs = [shop("shop", "plain"), shop("shop_amb", "choice"), shop("shop_noerror", "strict", ("p2", "p3")),
            C.Run("shop", "whole", run_id="shop_whole"), C.Run("shop_amb", "front", FIRST_EVENTS, run_id="shop_front")]
    return flat(C.check_logs(S.order_events(day_log(spark, sf_dir)), demo_nets(spark), runs))


def sort_sessions_hot(spark, sf_dir):
    return S.order_events(quarter_log(spark, sf_dir), hot_rows=1000).rows("pos", "event")


def trim_sessions_hot(spark, sf_dir):
    return S.trim_sessions(S.order_events(quarter_log(spark, sf_dir), hot_rows=1000), FIRST_EVENTS, LAST_EVENTS).rows("pos", "event")


def replay_scan_hot(spark, sf_dir):
    sessions = S.order_events(quarter_log(spark, sf_dir), hot_rows=1000)
    return flat(C.check_logs(sessions, demo_nets(spark), [shop()], method="scan")).drop("model_id")


LONG_RUNS = [C.Run("shop_amb"), C.Run("switch", expected_final=("p2",))]


def check_logs_long(spark, sf_dir):
    """Sessions longer than a segment, on a model with a choice and on one that changes with every event."""
    return flat(C.check_logs(S.order_events(quarter_log(spark, sf_dir)), demo_nets(spark), LONG_RUNS))


def check_logs_segments(spark, sf_dir):
    """The same of many short segments."""
    return flat(C.check_logs(S.order_events(shard_log(spark, sf_dir)), demo_nets(spark), LONG_RUNS, segment=101))


def check_logs_prefixes(spark, sf_dir):
    return _check(spark, day_log(spark, sf_dir), shop("shop_amb"), share_prefixes=True)


def missing_steps(spark, sf_dir):
    """The ledger of missing and left tokens, of a model without and of one with choices."""
    runs = [shop("shop"), shop("shop_amb")]
    return L.token_ledger(S.order_events(day_log(spark, sf_dir)), demo_nets(spark), runs)


def missing_steps_hot(spark, sf_dir):
    """The ledger of sessions that are split over tasks and folded in several segments."""
    sessions = S.order_events(shard_log(spark, sf_dir), hot_rows=200)
    return L.token_ledger(sessions, demo_nets(spark), [C.Run("shop"), *LONG_RUNS], segment=101)


def unknown_events(spark, sf_dir):
    return C.unknown_events(user_log(spark, sf_dir), demo_nets(spark), "shop_noerror").select(
        "case_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event")


# --- reports -----------------------------------------------------------------------


def _report(spark, sf_dir, run: C.Run) -> DataFrame:
    as_of = F.to_date(F.lit(AS_OF))
    return R.conformance_report(day_log(spark, sf_dir), demo_nets(spark), [run], as_of)


def conformance_report(spark, sf_dir):
    return _report(spark, sf_dir, shop())


def report_lines(spark, sf_dir):
    return R.report_lines(_report(spark, sf_dir, shop("shop_noerror")))


def save_report(spark, sf_dir):
    path = shared_path(spark, "report")
    R.save_report(_report(spark, sf_dir, shop("shop_noerror", "strict")), path)
    return read_delimited(spark, path, R.REPORT_COLUMNS)


def surrounding_events(spark, sf_dir):
    """Over whole hours and whole user histories, so that every form of the text occurs."""
    reports = [
        C.generate_report(S.order_events(log(spark, sf_dir)), demo_nets(spark), [C.Run("shop")]) for log in (hour_log, user_log)]
    return flat(S.union_all(reports)).select("case_id", "session_length", "surrounding_events")


def generate_report(spark, sf_dir):
    return flat(C.generate_report(S.order_events(day_log(spark, sf_dir)), demo_nets(spark), [shop()])).drop("model_id")


def member_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``day_log``, but users whose number ends with 0 have no case: their rows are rejects."""
    member = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    day = F.concat(member.cast("string"), F.lit("@"), F.to_date("ts").cast("string"))
    return S.extract_event_log(table(spark, sf_dir, "events"), day, "ts", "event_type")


def run_counters(spark, sf_dir):
    """Counters of the rows read and of the results, filled while the results are written."""
    counters, outcomes = R.RunCounters(), ("conformant", "deviating", STATUS_UNKNOWN_EVENT, STATUS_PATH_EXPLOSION)
    counters.register("rows")
    counters.register("rejected_rows", ~S.is_complete_record())
    for outcome in outcomes:
        counters.register(outcome, R.outcome() == outcome)
    counters.register("missing_tokens", value=F.col("missing_count"))
    counters.register("session_events", value=F.col("session_length"), start=1000)
    results = R.watched_counts(
        member_log(spark, sf_dir), demo_nets(spark), [shop("shop_noerror")], counters, ("rows", "rejected_rows"),
        (*outcomes, "missing_tokens", "session_events"))
    results.write.parquet(shared_path(spark, "counted-results"))
    return local_table(spark, counters.values().items(), "counter string, value bigint")


def outcome_counts(spark, sf_dir):
    results = C.check_counts(S.order_events(day_log(spark, sf_dir)), demo_nets(spark), [shop("shop_noerror"), shop("shop_amb")])
    return R.count_outcomes(results)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        delimited_scan, extract_event_log, group_sessions, sort_sessions, sessions_with_start, trim_start,
        complete_sessions, trim_end, trim_sessions, extract_logs, session_length, model_places,
        model_transition_lookup, model_arcs, model_initial_marking, model_delete_transition,
        model_merge_transitions, model_suffix_ids, model_input_transitions, model_output_transitions,
        event_transition_lookup, transition_missing_ratio, least_missing_transitions, replay_deterministic,
        final_marking, check_logs, replay_ambiguous, check_logs_ambiguous, replay_path_explosion,
        conformance_multi_model, unknown_events, conformance_report, report_lines, save_report,
        surrounding_events, generate_report, run_counters, sort_sessions_hot, trim_sessions_hot, replay_scan_hot, check_logs_long,
        model_scan, check_logs_segments, check_logs_prefixes, missing_steps, missing_steps_hot, model_edit_log, outcome_counts,
    ]
    return {query.__name__: query for query in listed}
