"""Identity, scoring, tagging, routing and gating of documents and pages; money, dates, lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions import dates, money, text
from ledgerloom.operators.merge import one_per_key
from ledgerloom.operators.summary import recent, route_health
from ledgerloom.operators.textlines import line_tag, parse_text
from ledgerloom.sources.files import pages_pass_gate, score_documents
from workload.registry import query, table

DATE_SQL = "|".join(rules.DATE_PATTERNS)


@query("content_hash", "select doc_id, sha256(text) as statement_hash from documents")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.content_hash(F.col("text")).alias("statement_hash"))


@query(
    "content_dedup",
    """select statement_hash, doc_id, source, lang from (
         select sha256(text) as statement_hash, doc_id, source, lang,
                row_number() over (partition by sha256(text) order by doc_id) as n from documents) where n = 1""",
)
def content_dedup(spark: SparkSession, d: str) -> DataFrame:
    hashed = table(spark, d, "documents").select(
        text.content_hash(F.col("text")).alias("statement_hash"), "doc_id", "source", "lang"
    )
    return one_per_key(hashed, "statement_hash", ["doc_id"])


# issuer mentions, dates and keywords mixed into the given texts
_MENTIONS = (
    "", "mail us at ICICIBank.com", "HDFC Bank and ICICI bank", "sbi.co.in", "aixsbank.com", "Kotak.com",
    "IndusInd Bank 12 Mar 2024", "Punjab National Bank 01/02/2024", "Bank of Baroda 2024-01-31", "axis  bank",
    "Statement of account, opening balance", "UPI", "IFSC code and MICR code",
)


def _mention(key: str) -> Column:
    return F.element_at(F.array(*map(F.lit, _MENTIONS)), (F.col(key) % len(_MENTIONS) + 1).cast("int"))


def _mention_sql(key: str) -> str:
    return "[" + ", ".join(f"'{m}'" for m in _MENTIONS) + f"][{key} % {len(_MENTIONS)} + 1]"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """Documents as bronze rows: pages and table rows vary, texts are whole."""
    return _score(table(spark, d, "documents"))


def _score(documents: DataFrame) -> DataFrame:
    docs = documents.select(
        "doc_id",
        "source",
        F.concat_ws("\n", _mention("doc_id"), F.col("text")).alias("raw_text"),
        (F.col("doc_id") % 5).cast("int").alias("num_pages"),
        (F.col("doc_id") % 3).cast("int").alias("table_row_count"),
        F.when(F.col("n_chars") < 200, F.lit("too little text")).alias("extraction_error"),
    )
    return docs.select(
        "doc_id",
        "source",
        "extraction_error",
        text.quality_score(F.col("raw_text"), F.col("num_pages"), F.col("table_row_count")).alias("score"),
        text.source_tag(F.col("raw_text")).alias("bank_format"),
    ).withColumn("route", text.route(F.col("score")))


_ISSUER_SQL = " ".join(
    "when " + " or ".join(f"contains(lower(raw_text), '{w}')" for w in words) + f" then '{issuer}'"
    for issuer, words in rules.ISSUERS
)
_BLANKS_SQL = " || ".join(f"chr({ord(c)})" for c in rules.BLANKS)
_SCORED_SQL = rf"""
docs as (
  select doc_id, source, {_mention_sql("doc_id")} || chr(10) || text as raw_text, doc_id % 5 as num_pages,
         doc_id % 3 as table_rows, case when n_chars < 200 then 'too little text' end as extraction_error
  from documents),
sized as (select *, length(trim(raw_text, {_BLANKS_SQL}))::double as size from docs),
parts as (
  select *, least(size / greatest(num_pages, 1) / 800.0::double, 1.0::double) as density,
         case when regexp_matches(raw_text, '{DATE_SQL}') then 1.0::double else 0.0::double end as dated,
         1.0::double - (length(regexp_replace(raw_text, '[\p{{C}}\p{{Z}}]', '', 'g'))
            + length(raw_text) - length(replace(raw_text, ' ', ''))) / greatest(size, 1.0::double) as garble,
         case when table_rows > 0 then 1.0::double else 0.3::double end as tabular
  from sized),
scored as (
  select doc_id, source, extraction_error, case {_ISSUER_SQL} else 'UNKNOWN' end as bank_format,
         case when num_pages = 0 then 0.0::double else round(density * 0.35::double + dated * 0.25::double
           + greatest(0.0::double, 1.0::double - garble * 5) * 0.2::double + tabular * 0.2::double, 3) end as score
  from parts)"""


@query("quality_score", f"with {_SCORED_SQL} select doc_id, score from scored")
def quality_score(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("doc_id", "score")


@query("source_tag", f"with {_SCORED_SQL} select doc_id, bank_format from scored")
def source_tag(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("doc_id", "bank_format")


@query(
    "route_health",
    f"""with {_SCORED_SQL} select case when score >= 0.6 then 'CPU' else 'GPU_FALLBACK' end as route,
        extraction_error is not null as has_error, count(*) as count from scored group by 1, 2""",
)
def route_health_query(spark: SparkSession, d: str) -> DataFrame:
    return route_health(_scored(spark, d))


@query(
    "recent_top20",
    f"""with {_SCORED_SQL} select doc_id, bank_format, score, extraction_error from scored
        order by doc_id desc limit 20""",
)
def recent_top20(spark: SparkSession, d: str) -> DataFrame:
    latest = recent(table(spark, d, "documents"), "doc_id", "source")
    return _score(latest).select("doc_id", "bank_format", "score", "extraction_error")


_MATCHES_SQL = " + ".join(f"contains(low, '{w}')::int" for w in rules.GATE_KEYWORDS)


@query(
    "keyword_gate",
    f"""with t as (select page_id, lower({_mention_sql("page_id")} || chr(10) || html) as low from pages),
    m as (select page_id, {_MATCHES_SQL} as matches from t)
    select page_id, matches, (matches >= 2)::int as passes from m""",
)
def keyword_gate(spark: SparkSession, d: str) -> DataFrame:
    whole = F.concat_ws("\n", _mention("page_id"), F.col("html"))
    return (
        table(spark, d, "pages")
        .select("page_id", text.keyword_matches(whole).alias("matches"))
        .withColumn("passes", (F.col("matches") >= rules.GATE_MIN_MATCHES).cast("int"))
    )


_KEYWORDS_IN_HEAD_SQL = " + ".join(f"contains(head, '{w}')::int" for w in rules.GATE_KEYWORDS)


@query(
    "bronze_rows",
    rf"""with paged as (
      select doc_id, sha256(text) as statement_hash, string_split({_mention_sql("doc_id")} || chr(10) || text, chr(10)) as pages,
             doc_id % 4 as t from documents),
    docs as (
      select *, array_to_string(pages, chr(10)) as raw_text, len(pages) as num_pages, t * 2 as table_rows,
             lower(array_to_string(pages[1:2], chr(10))) as head from paged),
    {_SCORED_SQL[_SCORED_SQL.index("sized as"):_SCORED_SQL.index("scored as")].rstrip().rstrip(",")},
    scored as (
      select *, round(density * 0.35::double + dated * 0.25::double + greatest(0.0::double, 1.0::double - garble * 5) * 0.2::double
                + tabular * 0.2::double, 3) as score from parts)
    select doc_id, statement_hash, num_pages, table_rows as table_row_count, case {_ISSUER_SQL} else 'UNKNOWN' end as bank_format,
      score as extraction_confidence, case when score >= 0.6 then 'CPU' else 'GPU_FALLBACK' end as route, length(raw_text) as chars,
      ({_KEYWORDS_IN_HEAD_SQL} >= 2)::int as passes from scored""",
)
def bronze_rows(spark: SparkSession, d: str) -> DataFrame:
    """Documents with their lines as pages and up to three tables each -> bronze rows and gate verdict."""
    cell_table = F.array(F.array(F.lit("a"), F.lit(None).cast("string")), F.array(F.lit("b")))
    decoded = table(spark, d, "documents").select(
        "doc_id",
        text.content_hash(F.col("text")).alias("statement_hash"),
        F.split(F.concat_ws("\n", _mention("doc_id"), F.col("text")), "\n", -1).alias("pages"),
        F.array_repeat(cell_table, (F.col("doc_id") % 4).cast("int")).alias("tables"),
        F.lit(None).cast("string").alias("extraction_error"),
    ).withColumn("passes", pages_pass_gate(F.col("pages"), first=2).cast("int"))
    return score_documents(decoded).select(
        "doc_id", "statement_hash", "num_pages", "table_row_count", "bank_format", "extraction_confidence", "route",
        F.length("raw_text").alias("chars"), "passes",
    )


@query(
    "bronze_tables",
    rf"""select doc_id, '[' || array_to_string(list_transform(range(50 + (doc_id % 20)::int),
             lambda i: '[["' || i || '",null],["b"]]'), ',') || ']' as tables_json,
           2 * (50 + doc_id % 20)::int as table_row_count, ({_KEYWORDS_IN_HEAD_SQL} >= 2)::int as passes
    from (select doc_id, lower({_mention_sql("doc_id")} || chr(10) || text) as head from documents)""",
)
def bronze_tables(spark: SparkSession, d: str) -> DataFrame:
    """Documents with 50 to 69 tables each: all of them stay, and the gate reads all pages."""
    count = (50 + F.col("doc_id") % 20).cast("int")
    tables = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.array(F.array(i.cast("string"), F.lit(None).cast("string")), F.array(F.lit("b"))),
    )
    decoded = table(spark, d, "documents").select(
        "doc_id",
        text.content_hash(F.col("text")).alias("statement_hash"),
        F.split(F.concat_ws("\n", _mention("doc_id"), F.col("text")), "\n", -1).alias("pages"),
        tables.alias("tables"),
        F.lit(None).cast("string").alias("extraction_error"),
    ).withColumn("passes", pages_pass_gate(F.col("pages")).cast("int"))
    return score_documents(decoded).select("doc_id", "tables_json", "table_row_count", "passes")


def _pick(key: str, choices: list[Column]) -> Column:
    """Choice by key; only the chosen one is computed."""
    at = F.col(key) % len(choices)
    chain = F.when(at == 0, choices[0])
    for i, choice in enumerate(choices[1:], 1):
        chain = chain.when(at == i, choice)
    return chain


@query(
    "parse_money",
    """with o as (select o_orderkey, o_orderkey % 12 as k, round(o_totalprice, 2) as p from orders)
    select o_orderkey, case when k in (6, 7, 11) then null when k = 4 then -p else p end as value,
           case when k = 3 then 'CREDIT' when k in (5, 9) then 'DEBIT' end as direction from o""",
)
def parse_money(spark: SparkSession, d: str) -> DataFrame:
    p = F.format_number("o_totalprice", 2)
    cells = [
        F.concat(F.lit("₹ "), p), F.concat(F.lit("Rs."), p), F.concat(F.lit(" INR "), p), F.concat(p, F.lit(" Cr")),
        F.concat(F.lit("("), p, F.lit(")")), F.concat(p, F.lit(" (Dr)")), F.format_number("o_totalprice", 0),
        F.concat(F.lit("-"), p), F.concat(F.lit("$"), p), F.concat(p, F.lit("dr.")),
        F.concat(F.lit("​ "), p), F.lit(""),
    ]
    parsed = money.parse_money(_pick("o_orderkey", cells))
    return (
        table(spark, d, "orders").select("o_orderkey", parsed.alias("m")).select("o_orderkey", "m.value", "m.direction")
    )


# Spark pattern of each accepted date layout
_LAYOUTS = (
    "dd/MM/yyyy", "d-M-yyyy", "dd.MM.yyyy", "dd/MM/yy", "d-M-yy", "dd.MM.yy", "dd MMM yyyy", "d-MMM-yyyy",
    "dd/MMM/yyyy", "d MMM yy", "dd-MMM-yy", "d/MMM/yy", "dd MMMM yyyy", "d-MMMM-yyyy", "dd/MMMM/yyyy",
    "yyyy-MM-dd", "yyyy/M/d", "yyyy.MM.dd",
)


@query(
    "parse_date",
    f"""select o_orderkey, case when o_orderkey % {len(_LAYOUTS) + 3} < {len(_LAYOUTS)}
          then strftime(o_orderdate, '%Y-%m-%d') end as parsed from orders""",
)
def parse_date(spark: SparkSession, d: str) -> DataFrame:
    cells = [F.date_format("o_orderdate", layout) for layout in _LAYOUTS]
    cells = [F.upper(c) if i % 2 else F.concat(F.lit(" "), c) for i, c in enumerate(cells)]
    cells += [F.lit("31/02/2024"), F.lit("01 Sept 2024"), F.date_format("o_orderdate", "yyyyMMdd")]
    return table(spark, d, "orders").select(
        "o_orderkey", dates.parse_date(_pick("o_orderkey", cells)).cast("string").alias("parsed")
    )


_LINE_KEY = ("l_orderkey", "l_linenumber")


@query(
    "extract_amounts",
    r"""with t as (select l_orderkey, l_linenumber,
        cast(round(l_extendedprice * 100) as bigint) as pc, cast(round(l_tax * 100) as bigint) as tc,
        l_returnflag as f, strftime(l_shipdate, '%d/%m/%Y') as day from lineitem)
    select l_orderkey, l_linenumber, day as first_date, 2 as n_amounts, pc / 100 as amount, tc / 100 as balance,
      case when f = 'R' then 'DEBIT' when f = 'A' then 'CREDIT' end as direction from t""",
)
def extract_amounts(spark: SparkSession, d: str) -> DataFrame:
    """First date, amounts, and the tag of the second last amount of a rendered line."""
    tag = F.when(F.col("l_returnflag") == "R", " (Dr)").when(F.col("l_returnflag") == "A", "Cr.").otherwise("")
    line = F.concat_ws(
        " ",
        F.lit("SHIP"),
        F.date_format("l_shipdate", "dd/MM/yyyy"),
        F.concat(F.format_number("l_extendedprice", 2), tag),
        F.format_number("l_tax", 2),
    )
    rendered = table(spark, d, "lineitem").select(*_LINE_KEY, line.alias("line"))
    found = rendered.withColumn("amounts", money.amounts_in(F.col("line")))
    second = money.last_amount(F.col("amounts"), 2)
    return found.select(
        *_LINE_KEY,
        dates.first_date(F.col("line")).alias("first_date"),
        F.size("amounts").alias("n_amounts"),
        money.amount_value(second).alias("amount"),
        money.amount_value(money.last_amount(F.col("amounts"))).alias("balance"),
        money.tag_of_amount(F.col("line"), second).alias("direction"),
    )


_TAG_SQL = rf"""case
  when regexp_matches(line, '(?i)^\s*page\s*\d+\s*$') or regexp_matches(line, '(?i)\bdate\b.*\bparticulars\b.*\bbalance\b') then null
  when regexp_matches(line, '(?i)\b(opening balance|closing balance|total|carried forward|b/f|c/f)\b') then 'K'
  when regexp_matches(line, '(?i)^\s*(chq|ref|cheque|reference)[\s:.]') then 'C'
  when regexp_matches(line, '{DATE_SQL}') and regexp_matches(line, '[\d,]+\.\d{{2}}') then 'S'
  when regexp_matches(line, '{DATE_SQL}') then 'D'
  when regexp_matches(line, '[\d,]+\.\d{{2}}') then 'A' else 'T' end"""
# every document, its dates and prices spread over lines by breaking at sentence ends
_DOC_LINES_SQL = rf"""
raw as (
  select doc_id, unnest(string_split(replace(text, '. ', chr(10)), chr(10))) as piece,
         generate_subscripts(string_split(replace(text, '. ', chr(10)), chr(10)), 1) as i from documents),
tagged as (
  select doc_id, i, line, {_TAG_SQL} as tag
  from (select doc_id, i, trim(piece, {_BLANKS_SQL}) as line from raw) where line <> '')"""


def _broken_text() -> Column:
    return F.replace(F.col("text"), F.lit(". "), F.lit("\n"))


@query(
    "segment_lines",
    f"with {_DOC_LINES_SQL} select doc_id, tag, count(*) as lines from tagged where tag is not null group by 1, 2",
)
def segment_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line roles over whole documents."""
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split(_broken_text(), "\n", -1)).alias("raw"))
    stripped = lines.select("doc_id", text.strip(F.col("raw")).alias("line")).filter(F.col("line") != "")
    tagged = stripped.select("doc_id", line_tag(F.col("line")).alias("tag")).filter(F.col("tag").isNotNull())
    return tagged.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "document_blocks",
    f"""with {_DOC_LINES_SQL},
    segments as (
      select *, coalesce(count(*) filter (tag in ('K', 'C')) over
        (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as seg
      from tagged where tag is not null),
    blocks as (
      select *, greatest(count(*) filter (tag = 'S') over (partition by doc_id, seg order by i) - 1, 0) as blk
      from segments),
    folded as (
      select doc_id, seg, blk, bool_or(tag = 'S') as s, bool_or(tag = 'D') as dd, bool_or(tag = 'A') as a,
             bool_or(tag = 'K') as k from blocks group by 1, 2, 3)
    select doc_id, count(*) as transactions from folded where not k and (s or (dd and a)) group by 1""",
)
def document_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Transactions the text parser finds in each whole document."""
    docs = table(spark, d, "documents").select("doc_id", _broken_text().alias("raw_text"))
    return parse_text(docs).groupBy("doc_id").agg(F.count(F.lit(1)).alias("transactions"))
