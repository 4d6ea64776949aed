"""Judges' work as tables: which answers are asked for, what came back, and the votes and comments in it.

Answers are rows (emr_id, model_id, round, role, block, attempt, raw). In round
1 a judge answers for each block by itself; in round 2 block is null and the
answer is a whole report; round 3 is the aggregator's. Who answers them isn't
known here: tasks go out as rows, and answers come back as rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from .. import lexicons as lx
from ..functions.text import unnested
from . import answers as read
from . import votes

PAIR = votes.PAIR
TASK = (*PAIR, "role", "block")
CODES = votes.CODES
_OWN = {code: [name for name, codes in lx.ANSWER_LISTS.items() if code in codes] for codes in CODES.values() for code in codes}
_CRITERION = "STRUCT<pass: BOOLEAN, comment: STRING{}>"
_BLOCK = {block: ", ".join([*(f"{c}: " + _CRITERION.format("".join(f", {name}: ARRAY<STRING>" for name in _OWN[c])) for c in codes), *(f"{name}: ARRAY<STRING>" for name, of in lx.BLOCK_LISTS.items() if of == block)]) for block, codes in CODES.items()}
#: One block's answer has its criteria at the top, a whole report has the blocks there; a field of another type reads as null.
_SCHEMA = f"STRUCT<{', '.join([*_BLOCK.values(), *(f'{block}: STRUCT<{fields}>' for block, fields in _BLOCK.items())])}>"
_NONE = "array<string>"
NO_ANSWER, NO_OBJECT, NO_PASS = "no answer", "no object", "no boolean pass: "


def tasks(gated: DataFrame, roles: Sequence[str], seed: int = 0) -> DataFrame:
    """(emr_id, model_id, role, block, place): what to ask in the first round, of every row of gated (pair, gate_status) that the gate lets through.

    Roles and blocks are literals of the plan, so nothing is joined or
    shuffled. place orders a pair's judges by a hash with the seed, the same
    in every run, so that no judge always comes first. A null gate_status
    counts as rejected; repeated pairs give repeated tasks.
    """
    placed = gated.where(F.coalesce(F.col("gate_status") != "reject", F.lit(False))).select(*PAIR, F.posexplode(_order(roles, seed)).alias("place", "_r"))
    return placed.select(*PAIR, F.col("_r.role").alias("role"), F.explode(F.array(*map(F.lit, CODES))).alias("block"), (F.col("place") + 1).alias("place"))


def asked(gated: DataFrame, roles: Sequence[str], first: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of tasks with what came back for each: the columns of first (see block_answers), null for a silent judge.

    Pairs and answers meet before a pair's tasks are told apart, so a pair is
    one row of the shuffle and not one for each judge and block. Ids are
    compared null-safe, and what follows may group within a pair as it lies.
    Columns that nobody needs should be dropped from first before.
    """
    told = F.struct(*(c for c in first.columns if c not in PAIR))
    back = first.select(*PAIR, F.lit(0).alias("_n"), told.alias("_t"))
    let = gated.where(F.coalesce(F.col("gate_status") != "reject", F.lit(False))).select(*PAIR, F.lit(1).alias("_n"), F.lit(None).cast(back.schema["_t"].dataType).alias("_t"))
    both = let.unionByName(back).groupBy(*PAIR).agg(F.sum("_n").cast("int").alias("_n"), F.collect_list("_t").alias("_all")).where("_n > 0")
    order = F.transform(_order(roles, seed), lambda r, k: F.struct(r["role"].alias("role"), (k + 1).alias("place")))
    each = F.flatten(F.transform(F.flatten(F.array_repeat(order, F.col("_n"))), lambda r: F.array(*(F.struct(r["role"].alias("role"), r["place"].alias("place"), F.lit(b).alias("block")) for b in CODES))))
    rows = both.select(*PAIR, "_all", F.explode(each).alias("_k"))
    own = F.get(F.filter("_all", lambda t: (t["role"] == F.col("_k.role")) & (t["block"] == F.col("_k.block"))), 0)
    return rows.select(*PAIR, "_k.role", "_k.block", "_k.place", own.alias("_own")).select(*TASK, "place", *(f"_own.{c}" for c in first.columns if c not in TASK))


def _order(roles: Sequence[str], seed: int) -> Column:
    return F.array_sort(F.array(*(F.struct(F.xxhash64(F.lit(seed), *PAIR, F.lit(role)).alias("h"), F.lit(role).alias("role")) for role in roles)))


def _told(parsed: Column, code: str) -> Column:
    """A criterion's vote, comment and listed items."""
    own = parsed[code]
    items = F.concat(F.array().cast(_NONE), *(F.coalesce(own[name], F.array().cast(_NONE)) for name in _OWN[code]))
    return F.struct(F.lit(code).alias("code"), own["pass"].alias("pass"), own["comment"].alias("comment"), items.alias("items"))


def _criteria(parsed: Column, block: str) -> Column:
    return F.array(*(_told(parsed, c) for c in CODES[block]))


def _lists(parsed: Column, block: str) -> Column:
    none = F.array().cast(_NONE)
    return F.concat(none, *(F.coalesce(parsed[name], none) for name, of in lx.BLOCK_LISTS.items() if of == block))


def block_answers(answers: DataFrame, valid_only: bool = False) -> DataFrame:
    """(pair, role, block, attempts, valid, error, criteria, listed): what counts of the first round's answers for each task that has any.

    An answer is valid if every criterion of its block is an object whose pass
    is a boolean; text such as "yes" is none. The first valid attempt counts,
    else the last broken one, which gives no votes and its error instead.
    criteria: array<struct<code, pass, comment, items>>. Of answers with one
    attempt number the one with the least text counts. Rows with a null role or
    an unknown block take no part. Many answers for one task are put
    together before the shuffle. valid_only leaves error, criteria and listed
    out, so that no text is shuffled.
    """
    first = read.parsed(answers.where("round = 1 AND role IS NOT NULL").where(F.col("block").isin(*CODES)), "raw", _SCHEMA)
    of = lambda make: F.coalesce(*(F.when(F.col("block") == b, make(F.col("parsed"), b)) for b in CODES))
    lost = F.transform(F.filter(F.col("_c"), lambda c: c["pass"].isNull()), lambda c: c["code"])
    told = first.withColumns({"_c": of(_criteria), "_l": of(_lists)}).withColumn("_lost", lost)
    error = F.when(F.col("raw").isNull(), NO_ANSWER).when(F.col("parsed").isNull(), NO_OBJECT).when(F.size("_lost") > 0, F.concat(F.lit(NO_PASS), F.array_join("_lost", ", ")))
    if valid_only:
        return told.groupBy(*TASK).agg(F.max("attempt").alias("attempts"), F.max(error.isNull()).alias("valid"))
    rank = F.struct(F.col("error").isNotNull(), F.when(F.col("error").isNull(), F.col("attempt")).otherwise(-F.col("attempt")), F.coalesce("raw", F.lit("")))
    best = told.withColumn("error", error).groupBy(*TASK).agg(F.max("attempt").alias("attempts"), F.min_by(F.struct("error", F.col("_c").alias("criteria"), F.col("_l").alias("listed")), rank).alias("_b"))
    return best.select(*TASK, "attempts", F.col("_b.error").isNull().alias("valid"), "_b.error", "_b.criteria", F.when(F.col("_b.error").isNull(), F.col("_b.listed")).otherwise(F.array().cast(_NONE)).alias("listed"))


_TOLD = ArrayType(StructType([StructField("role", StringType()), StructField("block", StringType()), StructField("attempts", IntegerType()), StructField("error", StringType()), StructField("votes", ArrayType(BooleanType())), StructField("comments", ArrayType(StringType()))]))


def _voted(block: str, raw: str | None) -> tuple[str | None, list, list]:
    """What is wrong with an answer, else its votes and comments by criterion; a comment that is no text is told as JSON."""
    if raw is None:
        return NO_ANSWER, [], []
    found = read.read(raw)
    if found is None:
        return NO_OBJECT, [], []
    own = [c if isinstance(c := found.get(code), dict) else {} for code in CODES[block]]
    if lost := [code for code, c in zip(CODES[block], own, strict=True) if not isinstance(c.get("pass"), bool)]:
        return NO_PASS + ", ".join(lost), [], []
    text = lambda c: c if c is None or isinstance(c, str) else json.dumps(c, ensure_ascii=False, separators=(",", ":"))
    return None, [c["pass"] for c in own], [text(c.get("comment")) for c in own]


def _counted(block: str, given: list[tuple[int | None, str | None]]) -> tuple[int | None, str | None, list, list]:
    """attempts, error, votes and comments of one task's answers, read only up to the first valid one."""
    attempts = max((a for a, _ in given if a is not None), default=None)
    for _, raw in sorted(given, key=lambda g: (g[0] is not None, g[0] or 0, g[1] or "")):
        if (told := _voted(block, raw))[0] is None:
            return attempts, *told
    _, raw = min(given, key=lambda g: (g[0] is not None, -(g[0] or 0), g[1] or "", g[1] is not None))
    return attempts, *_voted(block, raw)


@F.arrow_udf(_TOLD)
def best(answers: pa.Array) -> pa.Array:
    """Of each pair's answers (role, block, attempt, raw) the one of each task that counts, by the rules of block_answers."""
    flat = answers.flatten()
    rows = zip(*(flat.field(c).to_pylist() for c in ("role", "block", "attempt", "raw")), strict=True)
    sizes, out = [], []
    for n in pc.fill_null(pc.list_value_length(answers), 0).to_pylist():
        own: dict[tuple[str, str], list] = {}
        for _ in range(n):
            role, block, attempt, raw = next(rows)
            own.setdefault((role, block), []).append((attempt, raw))
        out += [(*task, *_counted(task[1], given)) for task, given in own.items()]
        sizes.append(len(own))
    role, block, attempts, error, votes_, comments_ = zip(*out, strict=True) if out else [()] * 6
    lists = lambda rows, kind: pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, rows))], pa.int32()), pa.array([x for own in rows for x in own], kind))
    fields = [pa.array(role, pa.string()), pa.array(block, pa.string()), pa.array(attempts, pa.int32()), pa.array(error, pa.string()), lists(votes_, pa.bool_()), lists(comments_, pa.string())]
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(sizes)], pa.int32()), pa.StructArray.from_arrays(fields, _TOLD.elementType.names))


def panels(gated: DataFrame, roles: Sequence[str], answers: DataFrame, parts: int | None = None) -> DataFrame:
    """(pair, n, told): every pair that the gate lets through, how often it is there, and what counts of its judges' first answers.

    told: array<struct<role, block, attempts, error, votes, comments>>, with a
    row for each task that has answers, votes and comments by criterion; those
    of broken answers are empty. Each answer is shuffled once, as it came, and
    read where its pair is put together. The rows are dealt out by record, into
    parts tasks, so that what follows may group by record or pair as they lie.
    """
    first = answers.where("round = 1").where(F.col("role").isin(*roles) & F.col("block").isin(*CODES))
    back = first.select(*PAIR, F.lit(0).alias("_n"), F.struct("role", "block", F.col("attempt").cast("int").alias("attempt"), F.col("raw").cast("string").alias("raw")).alias("_a"))
    let = gated.where(F.coalesce(F.col("gate_status") != "reject", F.lit(False))).select(*PAIR, F.lit(1).alias("_n"), F.lit(None).cast(back.schema["_a"].dataType).alias("_a"))
    dealt = let.unionByName(back).repartition(*([parts] if parts else []), "emr_id")
    both = dealt.groupBy(*PAIR).agg(F.sum("_n").cast("int").alias("n"), F.collect_list("_a").alias("_all")).where("n > 0")
    return both.select(*PAIR, "n", best.asNondeterministic()("_all").alias("told"))


def panel_blocks(panels: DataFrame, roles: Sequence[str]) -> DataFrame:
    """(pair, n, block, given, without): the valid answers on each block of pairs with panels, and the roles that gave none."""
    every = F.array(*map(F.lit, sorted(set(roles))))
    valid = panels.select(*PAIR, "n", F.filter("told", lambda t: t["error"].isNull()).alias("_v"))
    rows = valid.select(*PAIR, "n", "_v", F.explode(F.array(*map(F.lit, CODES))).alias("block"))
    given = rows.select(*PAIR, "n", "block", F.filter("_v", lambda t: t["block"] == F.col("block")).alias("given"))
    return given.withColumn("without", F.array_except(every, F.transform("given", lambda t: t["role"])))


def failed_by(given: Column, block: Column) -> Column:
    """array<struct<code, role, comment, fails>>: the votes against a criterion among a block's valid answers (see panel_blocks), by code and role; fails tells whether its majority fails."""
    codes = F.create_map(*(x for b, own in CODES.items() for x in (F.lit(b), F.array(*map(F.lit, own)))))

    def against(code: Column, i: Column) -> Column:
        no = F.filter(given, lambda t: ~F.get(t["votes"], i))
        return F.transform(no, lambda t: F.struct(code.alias("code"), t["role"].alias("role"), F.get(t["comments"], i).alias("comment"), (2 * F.size(no) >= F.size(given)).alias("fails")))

    return F.array_sort(F.flatten(F.transform(codes[block], against)))


def panel_comments(panels: DataFrame, roles: Sequence[str]) -> DataFrame:
    """comments of pairs with panels, told within each pair."""
    rows = panel_blocks(panels, roles).where(F.size("given") > 0)
    said = F.filter(failed_by(F.col("given"), F.col("block")), lambda x: x["fails"] & (x["comment"] != ""))
    lines = F.transform(said, lambda x: F.format_string(lx.COMMENT, x["code"], x["role"], x["comment"]))
    text = F.transform(F.array(F.array_join(lines, lx.COMMENT_JOIN)), lambda c: F.nullif(c, F.lit("")))
    return unnested(rows, text, "comments", *PAIR, "block")


def _tasks_with(tasks: DataFrame, first: DataFrame) -> DataFrame:
    """tasks with what came back for each; ids are compared null-safe."""
    same = F.lit(True)
    for c in TASK:
        same = same & F.col(f"t.{c}").eqNullSafe(F.col(f"a.{c}"))
    # by sorting: the optimizer knows nothing of how many tasks a pair gives, and would broadcast them
    return tasks.alias("t").join(first.alias("a").hint("merge"), same, "left").select("t.*", *(f"a.{c}" for c in ("attempts", "valid", "error", "criteria", "listed")))


def pending(tasks: DataFrame, first: DataFrame, most: int = 4) -> DataFrame:
    """(pair, role, block, place, attempt, short): the tasks to ask next, those without a valid answer after fewer than most attempts.

    From the second attempt on the short form of the question is asked. A task
    that has used its attempts stays without votes.
    """
    return pending_of(_tasks_with(tasks, first), most)


def pending_of(told: DataFrame, most: int = 4) -> DataFrame:
    """pending of tasks that have their answers (see asked): place, attempts and valid are read."""
    left = told.where(~F.coalesce("valid", F.lit(False)) & (F.coalesce("attempts", F.lit(0)) < most))
    attempt = F.coalesce("attempts", F.lit(0)) + 1
    return left.select(*TASK, "place", attempt.cast("int").alias("attempt"), (attempt > 1).alias("short"))


def first_votes(tasks: DataFrame, first: DataFrame) -> DataFrame:
    """Votes of round 1 (see votes) with comment, items and error: one row for each task and criterion.

    A judge who is silent, or whose answer is broken, has null votes on that
    block, "no data" and not "failed"; the judge's other blocks keep theirs.
    """
    return votes_of(_tasks_with(tasks, first))


def votes_of(rows: DataFrame) -> DataFrame:
    """first_votes of tasks that have their answers (see asked): valid, error and criteria are read."""
    blank = F.coalesce(*(F.when(F.col("block") == b, F.array(*(F.struct(F.lit(c).alias("code"), F.lit(None).cast("boolean").alias("pass"), F.lit(None).cast("string").alias("comment"), F.array().cast(_NONE).alias("items")) for c in codes))) for b, codes in CODES.items()))
    valid = F.coalesce("valid", F.lit(False))
    return rows.select(*PAIR, F.lit(1).alias("round"), "role", "block", F.explode(F.when(valid, F.col("criteria")).otherwise(blank)).alias("_c"), F.when(~valid, F.coalesce("error", F.lit(NO_ANSWER))).alias("error")).select(*PAIR, "round", "role", "block", "_c.*", "error")


def revised_votes(answers: DataFrame) -> DataFrame:
    """Votes of round 2, like first_votes: whole reports, read criterion by criterion.

    A criterion without a boolean pass has a null vote, so that votes.final_votes
    leaves the judge's first vote standing; a report that can't be read revises
    nothing. The last attempt counts.
    """
    reports = read.parsed(answers.where("round = 2 AND role IS NOT NULL"), "raw", _SCHEMA)
    told = reports.select(*PAIR, "role", "attempt", "raw", F.array(*(F.struct(F.lit(b).alias("block"), _criteria(F.col("parsed")[b], b).alias("criteria")) for b in CODES)).alias("_blocks"), F.when(F.col("parsed").isNull(), NO_OBJECT).alias("error"))
    last = told.groupBy(*PAIR, "role").agg(F.max_by(F.struct("_blocks", "error"), F.struct("attempt", F.coalesce("raw", F.lit("")))).alias("_b"))
    blocks = last.select(*PAIR, F.lit(2).alias("round"), "role", F.explode("_b._blocks").alias("_block"), "_b.error")
    return blocks.select(*PAIR, "round", "role", F.col("_block.block").alias("block"), F.explode("_block.criteria").alias("_c"), "error").select(*PAIR, "round", "role", "block", "_c.*", "error")


def reviews(first: DataFrame, seed: int = 0) -> DataFrame:
    """(pair, role, place, own, peers): the second round's tasks, a judge's report as JSON with those of two others.

    Judges with one valid block or more take part, in the order of a hash with
    the seed. Fewer than three of them see a peer twice, and a lone one itself.
    A pair has a report for each judge, so a group holds as many rows as judges.
    """
    fields = F.struct("block", F.struct("criteria", "listed").alias("told"))
    reports = first.where("valid").groupBy(*PAIR, "role").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(fields)))).alias("report"))
    placed = F.struct(F.xxhash64(F.lit(seed), *PAIR, "role").alias("h"), "role", "report")
    panels = reports.groupBy(*PAIR).agg(F.array_sort(F.collect_list(placed)).alias("_all"))
    each = panels.select(*PAIR, "_all", F.posexplode("_all").alias("place", "_me"))
    others = F.filter("_all", lambda j: j["role"] != F.col("_me.role"))
    two = F.when(F.size(others) >= 2, F.slice(others, 1, 2)).when(F.size(others) == 1, F.array_repeat(others[0], 2)).otherwise(F.array_repeat(F.col("_me"), 2))
    return each.select(*PAIR, F.col("_me.role").alias("role"), (F.col("place") + 1).alias("place"), F.col("_me.report").alias("own"), F.transform(two, lambda j: j["report"]).alias("peers"))


def aggregates(answers: DataFrame) -> DataFrame:
    """(pair, flagged, named, llm_category, llm_verdict, error): the aggregator's answers of round 3, as votes.decide takes them.

    Valid are one of the three categories with a boolean on the stop signal;
    the first valid attempt counts. Else category is null, flagged is false and
    error tells what is wrong.
    """
    schema = "category STRING, e1_triggered BOOLEAN, e1_triggered_by ARRAY<STRING>, verdict STRING"
    third = read.parsed(answers.where("round = 3"), "raw", schema)
    known = F.coalesce(F.col("parsed.category").isin(lx.READY, lx.EDIT, lx.REJECT), F.lit(False))
    error = F.when(F.col("raw").isNull(), NO_ANSWER).when(F.col("parsed").isNull(), NO_OBJECT).when(~known, "no category").when(F.col("parsed.e1_triggered").isNull(), "no boolean e1_triggered")
    rank = F.struct(F.col("error").isNotNull(), F.when(F.col("error").isNull(), F.col("attempt")).otherwise(-F.col("attempt")), F.coalesce("raw", F.lit("")))
    best = third.withColumn("error", error).groupBy(*PAIR).agg(F.min_by(F.struct("error", "parsed"), rank).alias("_b"))
    fine, told = F.col("_b.error").isNull(), F.col("_b.parsed")
    named = F.when(fine, F.array_compact(told["e1_triggered_by"]))
    return best.select(*PAIR, F.when(fine, told["e1_triggered"]).otherwise(False).alias("flagged"), F.coalesce(named, F.array().cast(_NONE)).alias("named"), F.when(fine, told["category"]).alias("llm_category"), F.when(fine, told["verdict"]).alias("llm_verdict"), "_b.error")


def stop_consistency(final: DataFrame, voices: DataFrame) -> DataFrame:
    """(pair, raised_by, flagged, named, consistent) of every row of voices: whether the aggregator saw the stop signal that judges raised."""
    raised = F.coalesce("e1_sources", F.array().cast(_NONE))
    joined = voices.join(votes.stop_signals(final), list(PAIR), "left")
    return joined.select(*PAIR, raised.alias("raised_by"), "flagged", "named", ((F.size(raised) > 0) == F.col("flagged")).alias("consistent"))


def comments(told: DataFrame, criteria: DataFrame) -> DataFrame:
    """(pair, block, comments): what judges say on the criteria whose majority failed, by criterion and role.

    told are votes with comment (the ones that count, see counting); criteria
    those of votes.criteria. A criterion of a pair has one comment a judge.
    """
    said = told.where("pass = false AND comment <> ''").join(criteria.where("vote = false").select(*PAIR, "block", "code"), [*PAIR, "block", "code"])
    line = F.format_string(lx.COMMENT, "code", "role", "comment")
    rows = said.groupBy(*PAIR, "block").agg(F.array_sort(F.collect_list(F.struct("code", "role", line.alias("line")))).alias("_l"))
    return rows.select(*PAIR, "block", F.array_join(F.transform("_l", lambda x: x["line"]), lx.COMMENT_JOIN).alias("comments"))


def dangers(told: DataFrame) -> DataFrame:
    """(pair, examples): the judges' comments and examples on the stop criterion, by role."""
    raised = told.where((F.col("code") == lx.E1_CODE) & ~F.col("pass"))
    comment = F.coalesce("comment", F.lit(""))
    line = F.when(F.size("items") > 0, F.format_string(lx.E1_EXAMPLES_WITH_ITEMS, "role", comment, F.array_join("items", lx.E1_ITEM_JOIN))).otherwise(F.format_string(lx.E1_EXAMPLES, "role", comment))
    rows = raised.groupBy(*PAIR).agg(F.array_sort(F.collect_list(F.struct("role", line.alias("line")))).alias("_l"))
    return rows.select(*PAIR, F.array_join(F.transform("_l", lambda x: x["line"]), lx.E1_JUDGE_JOIN).alias("examples"))


def counting(told: DataFrame) -> DataFrame:
    """(pair, role, block, code, pass, comment, items): each judge's vote of the last round that has one, with what was said on it."""
    given = F.when(F.col("pass").isNotNull(), F.col("round"))
    rows = told.groupBy(*PAIR, "role", "block", "code").agg(F.max_by(F.struct("pass", "comment", "items"), given).alias("_v"))
    return rows.select(*PAIR, "role", "block", "code", "_v.pass", "_v.comment", F.coalesce("_v.items", F.array().cast(_NONE)).alias("items"))


def verdicts(decided: DataFrame, blocks: DataFrame, reasons: DataFrame | None = None) -> DataFrame:
    """decided (see votes.decide) with verdict, the decision in words.

    blocks are those of votes.blocks; a block without rows there has no valid
    vote on any criterion. reasons (pair, reasons) are the gate's.
    """
    codes = F.when(F.size("failed") > 0, F.col("failed")).otherwise(F.col("undetermined"))
    text = lambda form, block, listed: F.format_string(form, block, F.array_join(listed, ", "))
    part = F.when(F.size("failed") > 0, text(lx.ISSUE_FAILED, F.col("block"), codes)).otherwise(text(lx.ISSUE_OPEN, F.col("block"), codes))
    parts = blocks.where("status <> 'ok'").groupBy(*PAIR).agg(F.map_from_entries(F.collect_list(F.struct("block", part.alias("part")))).alias("_parts"))
    silent = F.create_map(*(x for b, codes in CODES.items() for x in (F.lit(b), F.lit(lx.ISSUE_OPEN % (b, ", ".join(codes))))))
    out = decided.join(parts, list(PAIR), "left")
    out = out.join(reasons.select(*PAIR, F.array_join("reasons", ", ").alias("_why")), list(PAIR), "left") if reasons is not None else out.withColumn("_why", F.lit(""))
    listed = F.array_join(F.transform("issue_blocks", lambda b: F.coalesce(F.try_element_at("_parts", b), silent[b])), "; ")
    named = F.array_join("e1_sources", ", ")
    said = (
        F.when(F.col("gate_status") == "reject", F.format_string(lx.VERDICT_GATE, F.coalesce("_why", F.lit(""))))
        .when((F.col("category") == lx.REJECT) & (F.size("e1_sources") > 0), F.format_string(lx.VERDICT_STOP, "category", named))
        .when(F.size("issue_blocks") == 0, F.format_string(lx.VERDICT_CLEAN, "category"))
        .otherwise(F.format_string(lx.VERDICT_ISSUES, "category", listed))
    )
    return out.withColumn("verdict", said).drop("_parts", "_why")
