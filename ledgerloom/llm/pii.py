"""Personal data by patterns, and terms that give protected values away by information content.

Protected entities are the values that the base patterns find. A term discloses an entity when seeing
the term makes the entity much more likely: with p(e) the share of documents that hold entity e, and
p(e|t) the share of documents with term t in which t stands near e, the pointwise mutual information
log p(e|t) / p(e) is compared with the entity's whole information -log p(e). For p(e|t) stands the lower
end of its Wilson interval, `z` deviations wide, which comes nearer to the plain share with every further
context; copies of a context are one piece of evidence. In a short text most words stand near an entity
whatever they are: a term's place in a window is by chance as likely as the window's share of the text's
words, and a pair counts only where the product of these shares over its contexts is small. Terms that reach
the share `alpha` of the information are generalised wherever they occur, and removed where they reach `remove`.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import RowIds, arrow_map, prepare, record_batch, text_or_empty
from ledgerloom.session import materialise

#: Kinds in order, and the base patterns in pieces that are each found in linear time.
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_RUN = re.compile(r"[0-9][0-9.]*")
CARD = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

#: Words on each side of an entity that count as near it.
WINDOW = 12
#: Share of an entity's information that a term must give away.
ALPHA = 0.9
#: From this share on, a term is removed, not generalised.
REMOVE = 0.99
#: Deviations by which p(e|t) is taken to be lower than the share that was seen.
DEVIATIONS = 0.4
#: The chance that a pair's places are an accident must be at most this.
CHANCE = 0.05
#: Disclosing terms that are sent to every task; more are joined with the rows' words.
BLOCK_TERMS = 200_000
#: Terms that a task counts before it hands its counts on.
COUNTED_TERMS = 200_000

_WORD = re.compile(r"[^\W\d_]{3,}")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match has one sign that parts it: the local part lies left of it, as far as the last match."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and EMAIL_LOCAL.match(text, start - 1):
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", last)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers between dots, from the left; the next match begins behind the last one."""
    for run in IP_RUN.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts = run.group().split(".")
        starts, at = [], run.start()
        for part in parts:
            starts.append(at)
            at += len(part) + 1
        i = 0
        while i + 3 < len(parts):
            own = parts[i : i + 4]
            if not all(own):
                i += 1
                continue
            numbers = [p.lstrip("0") for p in own]
            if all(len(p) < 4 and int(p or "0") <= 255 for p in numbers):
                yield starts[i], starts[i + 3] + len(own[3])
            i += 4


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; each kind leftmost and without overlaps."""
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in _emails(text)]
    if _DIGITS.search(text):
        out += [("ip", s, e) for s, e in _addresses(text)]
        for m in CARD.finditer(text):
            if 13 <= m.end() - m.start() <= 37:  # up to 19 digits and 18 signs between them
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_DIGITS.findall(m.group())) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def entity(kind: str, value: str) -> str:
    """A protected value as it is counted: digits of numbers, lower-case letters of addresses."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(_DIGITS.findall(value))}"


def contexts(docs: DataFrame, window: int) -> DataFrame:
    """row, entity, term, context, chance of every word near a protected value; term null: the value itself.

    `chance` is the window's share of the text's words. Rows are numbered here; write the result before
    two consumers read it.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = RowIds()
        for batch in batches:
            out: list[tuple] = []
            texts = batch.column("text").to_pylist()
            for row, text in zip(ids.take(len(texts)), texts):
                spans = base_spans(text)
                if not spans:
                    continue
                places = [(m.start(), m.end(), m.group().lower()) for m in _WORD.finditer(text)]
                starts, ends = [p[0] for p in places], [p[1] for p in places]
                words = [p[2] for p in places]
                inside = {w.lower() for _, s, e in spans for w in _WORD.findall(text[s:e])}
                for kind, s, e in spans:
                    left, right = bisect_right(ends, s), bisect_left(starts, e)
                    before, after = words[max(0, left - window) : left], words[right : right + window]
                    context = xxhash.xxh3_64_intdigest("\x00".join([*before, "", *after]).encode()) - (1 << 63)
                    name = entity(kind, text[s:e])
                    chance = (len(before) + len(after)) / max(1, len(words))
                    out.append((row, name, None, context, chance))
                    out += [(row, name, t, context, chance) for t in sorted({*before, *after} - inside)]
            rows = list(zip(*out)) or [()] * 5
            yield record_batch(
                row=(rows[0], pa.int64()),
                entity=(rows[1], pa.string()),
                term=(rows[2], pa.string()),
                context=(rows[3], pa.int64()),
                chance=(rows[4], pa.float64()),
            )

    source = docs.select(text_or_empty().alias("text"))
    return arrow_map(source, find, "row long, entity string, term string, context long, chance double")


def document_counts(docs: DataFrame) -> DataFrame:
    """term, documents: in how many rows each word occurs; every task adds up before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = record_batch(term=(list(counts), pa.string()), n=(list(counts.values()), pa.int64()))
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(set(map(str.lower, set(_WORD.findall(text)))))
                if len(counts) > COUNTED_TERMS:
                    yield out()
        yield out()

    return arrow_map(docs.select(text_or_empty().alias("text")), count, "term string, n long").groupBy("term").agg(F.sum("n").alias("documents"))


def lower_bound(share: Column, hits: Column, z: float) -> Column:
    """Lower end of the Wilson interval of a share of which so many hits were seen."""
    n = hits / share
    middle = share + F.lit(z * z / 2) / n
    width = F.lit(z) * F.sqrt(share * (F.lit(1.0) - share) / n + F.lit(z * z / 4) / (n * n))
    return (middle - width) / (F.lit(1.0) + F.lit(z * z) / n)


def disclosing_terms(
    docs: DataFrame,
    window: int = WINDOW,
    alpha: float = ALPHA,
    remove: float = REMOVE,
    z: float = DEVIATIONS,
    chance: float = CHANCE,
) -> DataFrame:
    """term, share (of an entity's information that it gives away, the largest), removed.

    Documents count by row, repeated rows too; as evidence, rows with the same context count once.
    """
    seen = materialise(contexts(docs, window), "contexts")
    total = docs.count()
    entities = seen.filter(F.col("term").isNull()).groupBy("entity").agg(F.count_distinct("row").alias("n_e"))
    near = seen.filter(F.col("term").isNotNull())
    rows = near.groupBy("entity", "term").agg(F.count_distinct("row").alias("n_et"))
    evidence = (
        near.groupBy("entity", "term", "context").agg(F.max("chance").alias("chance"))
        .groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum(F.log("chance")).alias("log_chance"))
        .filter(F.col("log_chance") <= F.log(F.lit(float(chance))))
    )
    pairs = rows.join(evidence, ["entity", "term"])
    rare = -F.log(F.col("n_e") / F.lit(float(max(1, total))))
    gain = F.log(lower_bound(F.col("n_et") / F.col("documents"), F.col("contexts"), z)) + rare
    # an entity in every document has no information to give away
    share: Column = F.when(rare > 0, gain / rare).otherwise(F.lit(0.0))
    shares = (
        pairs.join(document_counts(docs), "term").join(entities, "entity").groupBy("term").agg(F.max(share).alias("share"))
    )
    return shares.filter(F.col("share") >= alpha).withColumn("removed", F.col("share") >= remove)


def _rows_terms(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """uid, own: the disclosing terms that each row of (uid, text) holds, if any."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = [], []
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist()):
                own = set(map(str.lower, set(_WORD.findall(text))))
                names += [uid] * len(own)
                found += own
            yield record_batch(uid=(names, pa.int64()), term=(found, pa.string()))

    held = arrow_map(texts.select("uid", "text"), words, "uid long, term string").join(terms.select("term", "removed"), "term")
    return held.groupBy("uid").agg(F.collect_list(F.struct("term", "removed")).alias("own"))


def sanitise(docs: DataFrame, window: int = WINDOW, alpha: float = ALPHA, remove: float = REMOVE, z: float = DEVIATIONS, chance: float = CHANCE) -> DataFrame:
    """doc_id, spans (array of kind, start, end, code points) and sanitised (text) of every row.

    Base spans become their kind in square brackets, disclosing terms `[TERM]`, or nothing if removed.
    Overlapping spans are replaced as one, by the first. Spans come by kind (base kinds in order, then
    terms), then start. A null text is empty. Repeated rows give a row each; other columns are not read.
    """
    terms = materialise(disclosing_terms(docs, window, alpha, remove, z, chance), "terms")
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind:string,start:int,end:int,removed:boolean>>"
    schema = f"uid long, doc_id {kind}, text string, spans {span}"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("removed", pa.bool_())]))

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = RowIds()
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e, "removed": False} for k, s, e in base_spans(t)] for t in batch.column("text").to_pylist()]
            yield record_batch(
                uid=(list(ids.take(batch.num_rows)), pa.int64()),
                doc_id=(batch.column("doc_id"), None),
                text=(batch.column("text"), None),
                spans=(spans, arrow),
            )

    out = arrow_map(docs.select("doc_id", text_or_empty().alias("text")), base, schema)
    few = terms.limit(BLOCK_TERMS + 1).collect()
    shared = None
    if len(few) <= BLOCK_TERMS:
        shared = docs.sparkSession.sparkContext.broadcast({r["term"]: r["removed"] for r in few})
        out = out.withColumn("own", F.lit(None).cast("array<struct<term:string,removed:boolean>>"))
    else:
        out = materialise(out, "spans")
        out = out.join(_rows_terms(out, terms), "uid", "left")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            for text, found, own in zip(batch.column("text").to_pylist(), spans, batch.column("own").to_pylist()):
                wanted = shared.value if shared else {t["term"]: t["removed"] for t in own or ()}
                if wanted.keys().isdisjoint(map(str.lower, set(_WORD.findall(text)))):
                    continue
                # base spans as stretches without overlaps, so that a word need only look at the one before its end
                taken: list[list[int]] = []
                for s, e in sorted((x["start"], x["end"]) for x in found):
                    if taken and s <= taken[-1][1]:
                        taken[-1][1] = max(taken[-1][1], e)
                    else:
                        taken.append([s, e])
                firsts = [s for s, _ in taken]
                for m in _WORD.finditer(text):
                    gone = wanted.get(m.group().lower())
                    if gone is not None:
                        k = bisect_left(firsts, m.end()) - 1
                        if k < 0 or taken[k][1] <= m.start():
                            found.append({"kind": TERM, "start": m.start(), "end": m.end(), "removed": gone})
            yield record_batch(doc_id=(batch.column("doc_id"), None), text=(batch.column("text"), None), spans=(spans, arrow))

    out = arrow_map(out.select("doc_id", "text", "spans", "own"), add, f"doc_id {kind}, text string, spans {span}")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [], batch.column("spans").to_pylist()
            for text, spans in zip(batch.column("text").to_pylist(), found):
                parts, at = [], 0
                for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [text[at : s["start"]], "" if s["removed"] else f"[{s['kind'].upper()}]"]
                    at = max(at, s["end"])
                texts.append("".join(parts) + text[at:])
            yield record_batch(doc_id=(batch.column("doc_id"), None), spans=(batch.column("spans"), None), sanitised=(texts, pa.string()))

    return arrow_map(out, replace, f"doc_id {kind}, spans {span}, sanitised string")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, base_sha256 and spans of `sanitise`."""
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    spans = F.col("spans")
    counts = [F.size(_of(spans, kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    base = written(F.filter(spans, lambda s: s["kind"] != TERM))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), written(spans).alias("spans"))


def _of(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)
