"""Secret scans over a ledger of blobs.

Every version of a document is named by the hash of its content, its blob. The ledger remembers which
blob has been scanned with which version of the rules, and what was found. Only pairs that it does not
hold are scanned; findings are then joined back to all documents and versions that have the blob.

Everything is built-in column functions: a text is split at a rule's matches, and the lengths of the
pieces and matches give the places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty
from ledgerloom.session import materialise, new_path


SPAN = "struct<start:int,end:int>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: `pattern` is found from the left without overlaps; of the matches those stay
    whose `group` has `least` characters or more. `hint` is a cheaper condition that a text with
    a valid match must meet."""

    kind: str
    pattern: str
    group: int
    least: int
    hint: str
    version: int = 1

    def possible(self, text: Column) -> Column:
        return F.rlike(text, F.lit(self.hint))

    def spans(self, text: Column) -> Column:
        """array<struct<start, end>> of the valid matches, in code points."""
        pattern = F.lit(self.pattern)
        whole = F.regexp_extract_all(text, pattern, F.lit(0))
        part = F.regexp_extract_all(text, pattern, F.lit(self.group)) if self.group else whole
        # split's pieces stand before each match; one more follows the last
        gaps = F.slice(F.split(text, self.pattern, -1), 1, F.size(whole))
        steps = F.transform(
            F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), part.alias("part")),
            lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("long"), F.length(x["part"]).alias("size")),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

        def step(acc: Column, s: Column) -> Column:
            begin, end = acc["at"] + s["gap"], acc["at"] + s["gap"] + s["long"]
            span = F.array(F.struct(begin.alias("start"), end.alias("end")))
            found = F.when(s["size"] >= self.least, F.concat(acc["found"], span)).otherwise(acc["found"])
            return F.struct(end.alias("at"), found.alias("found"))

        return F.aggregate(steps, start, step, lambda acc: acc["found"])


#: The base rules.
ASSIGN = Rule(
    "assign",
    "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    2,
    12,
    "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]",
)
ACCESS = Rule("access", "AKIA[A-Z0-9]+", 0, 18, "AKIA[A-Z0-9]{14}")
# a run of these characters is one match or none, so shorter runs may be left out by the pattern
HEX = Rule("hex", "[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}")
RULES = (ASSIGN, ACCESS, HEX)

def _pair(rule: Rule) -> str:
    return f"{rule.kind}:{rule.version}"


LEDGER = f"blob string, kind string, rule_version int, spans array<{SPAN}>"


def blobs(versions: DataFrame) -> DataFrame:
    """The versions' rows with `blob`, the SHA-256 of their text (null: empty)."""
    return versions.withColumn("blob", F.sha2(text_or_empty().cast("binary"), 256))


class BlobLedger:
    """What has been scanned and found, as a Parquet table that only grows."""

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule, ...] = RULES) -> None:
        self.spark, self.rules = spark, rules
        self.path = path or new_path(spark, "secret-ledger")

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], LEDGER)
            raise

    def _unseen(self, named: DataFrame) -> DataFrame:
        """blob, name (smallest doc_id that has it), missing (rules whose version the ledger has not for it)."""
        pair = F.concat_ws(":", "kind", "rule_version")
        current = [_pair(r) for r in self.rules]
        done = self.entries().filter(pair.isin(current)).groupBy("blob").agg(F.collect_set(pair).alias("seen"))
        wanted = F.array(*[F.lit(p) for p in current])
        missing = F.array_except(wanted, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
        first = named.groupBy("blob").agg(F.min("doc_id").alias("name"))
        return first.join(done, "blob", "left").select("blob", "name", missing.alias("missing")).filter(F.size("missing") > 0)

    def update(self, versions: DataFrame) -> None:
        """Scan the pairs of blob and rule version that are new in versions (doc_id, text) and append them."""
        named = blobs(versions.select("doc_id", text_or_empty().alias("text")))
        unseen = self._unseen(named.select("doc_id", "blob"))
        # one text of each such blob; the join moves every text once, by a key without copies
        fresh = named.join(
            unseen.select(F.col("blob").alias("own"), "name", "missing"),
            F.col("doc_id").eqNullSafe(F.col("name")) & (F.col("blob") == F.col("own")),
        )
        none = F.array().cast(f"array<{SPAN}>")

        def due(rule: Rule) -> Column:
            return F.array_contains("missing", _pair(rule))

        scanned = fresh.select(
            "blob",
            "missing",
            *[F.when(due(r) & r.possible(F.col("text")), r.spans(F.col("text"))).otherwise(none).alias(r.kind) for r in self.rules],
        ).dropDuplicates(["blob"])
        entry = [
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version"), F.col(r.kind).alias("spans"), due(r).alias("due"))
            for r in self.rules
        ]
        rows = scanned.select("blob", F.inline(F.array(*entry))).filter("due").drop("due")
        rows.write.mode("append").parquet(self.path)

    def findings(self, versions: DataFrame) -> DataFrame:
        """doc_id, blob and a column of spans per kind of every version row, from the ledger."""
        held = self.entries()
        per_kind = [
            F.max(F.when((F.col("kind") == r.kind) & (F.col("rule_version") == r.version), F.struct("spans")))["spans"].alias(r.kind)
            for r in self.rules
        ]
        # written down, so that the join with it may split a blob of many versions
        hits = materialise(held.filter(F.size("spans") > 0).groupBy("blob").agg(*per_kind), "secret-hits")
        none = F.array().cast(f"array<{SPAN}>")
        named = blobs(versions.select("doc_id", "text")).select("doc_id", "blob")
        return named.join(hits, "blob", "left").select("doc_id", "blob", *[F.coalesce(F.col(r.kind), none).alias(r.kind) for r in self.rules])


def scan_secrets(versions: DataFrame, ledger: BlobLedger | None = None) -> DataFrame:
    """doc_id, blob and spans per kind (array of start, end in code points, end exclusive) of every row.

    Bring the ledger up to date and join its findings back. A null text is empty; empty texts hold
    nothing; repeated rows are reported each; copies are scanned once. Other columns are not read.
    """
    ledger = ledger or BlobLedger(versions.sparkSession)
    ledger.update(versions)
    return ledger.findings(versions)


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts per kind, base_sha256 and spans of `scan_secrets`."""
    def listed(number: int, kind: str) -> Column:
        return F.transform(
            F.col(kind), lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"))
        )

    every = F.array_sort(F.concat(*[listed(k, r.kind) for k, r in enumerate(rules)]))
    spans = F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in rules]
    out = found.select("doc_id", *counts, spans.alias("spans"))
    return out.withColumn("base_sha256", F.sha2(F.col("spans").cast("binary"), 256))
