"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content.  The ledger is a table of (blob, kind, rule version) pairs
that were scanned, with their findings, so a run scans only pairs it doesn't hold yet: a content found at thousands of paths, or
again in a later version, is scanned once, and a new rule version is tried on old blobs.  Findings are then joined back to all
paths.  Everything is DataFrame work.

Defined cases: a null text is an empty blob.  Rows that repeat get a result each; a null path is kept.  Other columns are
carried along, but ``blob`` and ``findings`` replace columns of these names, and ``content`` and ``found`` are dropped.  An empty table
adds nothing and gives no rows.

A match's span counts code points, its end is exclusive.  Kinds beside those of ``BASE_RULES`` can be added to the rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inundation.llm.shared import keep


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group has ``least`` characters or more; ``hint`` must be found in any text with a match."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str


#: The base kinds, in the order in which spans that start together are listed.
BASE_RULES = (
    Rule(
        "assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""",
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14}"),
    # Runs under 16 characters are dropped anyway, and no shorter match can hide a longer one of the same run.
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)

_FINDING = "struct<start:bigint,rank:int,kind:string,stop:bigint>"
LEDGER_SCHEMA = f"blob string, kind string, rule_version int, findings array<{_FINDING}>"


def spans_of(text: Column, rule: Rule, rank: int = 0) -> Column:
    """Leftmost matches without overlap, as structs; those with too short a group are dropped.

    The text between the matches and the matches themselves give the positions.
    """
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    parts = F.arrays_zip(F.transform(between, F.length).alias("gap"), F.transform(whole, F.length).alias("size"), F.transform(tested, F.length).alias("tested"))
    empty = F.lit(None).cast(f"array<{_FINDING}>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.coalesce(empty, F.array().cast(f"array<{_FINDING}>")).alias("found"))

    def step(acc: Column, part: Column) -> Column:
        # The last part has a gap and no match.
        begin = acc["at"] + part["gap"]
        stop = begin + F.coalesce(part["size"], F.lit(0))
        found = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), stop.alias("stop"))
        fits = F.coalesce(part["tested"], F.lit(-1)) >= rule.least
        return F.struct(stop.alias("at"), F.when(fits, F.concat(acc["found"], F.array(found))).otherwise(acc["found"]).alias("found"))

    found = F.aggregate(parts, start, step)["found"]
    return F.when(text.rlike(rule.hint), found).otherwise(F.array().cast(f"array<{_FINDING}>"))


def blobs(versions: DataFrame, text_col: str = "text") -> DataFrame:
    """Each row with ``blob``, the address of its content, and ``content``."""
    content = F.coalesce(F.col(text_col), F.lit(""))
    return versions.withColumns({"content": content, "blob": F.sha2(content.cast("binary"), 256)})


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger in that folder, empty if there is none yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, rules: Sequence[Rule] = BASE_RULES, text_col: str = "text") -> DataFrame:
    """Rows for the ledger: one per blob and rule that it doesn't hold, also where nothing is found.

    Equal contents meet before and after the shuffle, so a group of copies of any size costs one row per task.
    """
    distinct = blobs(versions.select(text_col), text_col).select("blob", "content").dropDuplicates(["blob"])
    seen = F.array().cast("array<string>")
    if ledger is not None:
        known = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", F.col("rule_version").cast("string"))).alias("seen"))
        distinct = distinct.join(known, "blob", "left")
        seen = F.coalesce(F.col("seen"), seen)
    each = [
        F.when(
            ~F.array_contains(seen, f"{r.kind}:{r.version}"),
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version"), spans_of(F.col("content"), r, i).alias("findings")),
        )
        for i, r in enumerate(rules)
    ]
    scanned = distinct.select("blob", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("s"))
    return scanned.select("blob", "s.kind", "s.rule_version", "s.findings")


def update_ledger(versions: DataFrame, path: str, rules: Sequence[Rule] = BASE_RULES, text_col: str = "text") -> DataFrame:
    """Adds what the ledger in ``path`` doesn't hold yet, and returns all of it."""
    spark = versions.sparkSession
    ledger = read_ledger(spark, path)
    # The new rows are all computed from files that are there before, so a task that runs again finds the same.
    scan_unseen(versions, ledger, rules, text_col).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def update_in_steps(versions: DataFrame, path: str, id_col: str, steps: int = 2, rules: Sequence[Rule] = BASE_RULES, text_col: str = "text") -> DataFrame:
    """Updates the ledger by disjoint shares of the versions, by a hash of their id, one after another.

    Each share meets what those before it have left in the ledger: a blob that was scanned with one share isn't scanned with a later one.
    """
    share = F.pmod(F.xxhash64(id_col), F.lit(steps))
    ledger = None
    for i in range(steps):
        ledger = update_ledger(versions.where(share == i), path, rules, text_col)
    return ledger


def findings_by_path(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = BASE_RULES, text_col: str = "text") -> DataFrame:
    """Every row of ``versions`` with ``findings`` of the given rules, ordered by start and then as the rules are listed."""
    wanted = F.lit(False)
    for r in rules:
        wanted = wanted | ((F.col("kind") == r.kind) & (F.col("rule_version") == r.version))
    # A blob without findings needs no row here: the left join fills it in.
    found = ledger.where(wanted & (F.size("findings") > 0)).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("found"))
    # Kept first: a join of two plain tables can be split where one blob has a large share of the paths.
    joined = blobs(versions.drop("findings", "found"), text_col).drop("content").join(keep(found, "findings"), "blob", "left")
    return joined.withColumn("findings", F.coalesce("found", F.array().cast(f"array<{_FINDING}>"))).drop("found")


def spans_text(findings: Column) -> Column:
    """``kind:start:end`` of all findings, comma-joined."""
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with every finding replaced; findings that overlap become one mark."""
    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = text.substr((acc["at"] + 1).cast("int"), (F.greatest(s["start"] - acc["at"], F.lit(0))).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(findings, first, step, lambda acc: F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.length(text))))
