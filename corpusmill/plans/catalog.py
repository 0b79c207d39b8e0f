"""Named queries over the supplied tables, one or more for each operator, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import HEBREW_PROFILE, LATIN_PROFILE, FormatConfig
from corpusmill.functions import scrub as scrubbing
from corpusmill.functions import signals, text
from corpusmill.functions.columns import text_or_empty
from corpusmill.operators import dedup, qa, records, spans, stats, store, training
from corpusmill.plans import pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its own name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents, dealt over all cores: a small file reads as one partition, and the work is in the texts."""
    docs = table(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(cores)


def ratio(x: Column, name: str) -> Column:
    return F.round(x, 6).alias(name)


def TEXT() -> Column:  # noqa: N802  columns need a session, so even this one is made when a query runs
    return text_or_empty("text")


#: The weights that upsampling gives to the sources of the supplied tables.
FORMAT = FormatConfig(upsample={"src0": 1, "src1": 5, "src2": 5})

# ------------------------------------------------------------------ cleaning

CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(regexp_replace(regexp_replace(
  regexp_replace(nfc_normalize({0}), '[\x{{0591}}-\x{{05C7}}]', '', 'g'), '[\x{{200b}}-\x{{200f}}\x{{202a}}-\x{{202e}}\x{{feff}}]', '', 'g'),
  '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{{9f}}]', '', 'g'), chr(1470) || chr(1523) || chr(1524), '-''"'),
  '([\x{{0590}}-\x{{05FF}}])([a-zA-Z])', '\1 \2', 'g'), '([a-zA-Z])([\x{{0590}}-\x{{05FF}}])', '\1 \2', 'g'),
  '[\t\r\x0b\x0c \x{{a0}}]+', ' ', 'g'), '\n[ \t]+\n', chr(10) || chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13))"""


@query(f"SELECT doc_id, length(t) AS n_clean, md5(t) AS clean_md5 FROM (SELECT doc_id, {CLEAN.format('coalesce(text, chr(32))')} AS t FROM documents)")
def clean_text(spark, sf_dir):
    done = documents(spark, sf_dir).select("doc_id", text.clean_text(TEXT()).alias("t"))
    return done.select("doc_id", F.length("t").cast("long").alias("n_clean"), F.md5("t").alias("clean_md5"))


@query(
    f"""SELECT doc_id, md5(t) AS court_md5 FROM (SELECT doc_id, {CLEAN.format("regexp_replace(array_to_string(list_transform(string_split(body, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), chr(10)), chr(10) || '{3,}', chr(10) || chr(10), 'g')").replace('{3,}', '{3,}')} AS t
    FROM (SELECT doc_id, replace(coalesce(text, ''), ' ', '  ') || repeat(chr(10) || '  ', 3) || 'end  ' AS body FROM documents))"""
)
def clean_court_text(spark, sf_dir):
    body = F.concat(F.replace(TEXT(), F.lit(" "), F.lit("  ")), F.repeat(F.lit("\n  "), 3), F.lit("end  "))
    return documents(spark, sf_dir).select("doc_id", F.md5(text.clean_text(text.clean_lines(body))).alias("court_md5"))


WIKI_SQL = "'{{a{{b}}' || source || '}}[[File:' || lang || '|' || lang || ' page]] [[' || source || ']] [https://example.org/x ' || lang || '] [http://x.y] <b>bold</b> ''''''strong'''''' ==Head== {| table |} ' || coalesce(text, '')"


def _wiki() -> Column:
    lang, source = F.col("lang"), F.col("source")
    parts = ["{{a{{b}}", source, "}}[[File:", lang, "|", lang, " page]] [[", source, "]] [https://example.org/x ", lang, "] [http://x.y] <b>bold</b> '''strong''' ==Head== {| table |} ", TEXT()]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query(
    r"""SELECT doc_id, md5(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(w, '\{\{[^{}]*\}\}', '', 'g'), '\{\{[^{}]*\}\}', '', 'g'),
    '(?s)\{\|.*?\|\}', '', 'g'), '\[\[(?:[^|\]]*\|)?([^\]]*)\]\]', '\1', 'g'), '\[https?://[^\s\]]+(?: ([^\]]*))?\]', '\1', 'g'), '<[^>]+>', '', 'g'), '''''''', ''), '''''', ''), '==', '')) AS plain_md5
    FROM (SELECT doc_id, """
    + WIKI_SQL
    + " AS w FROM documents)"
)
def clean_wikitext(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(text.clean_wikitext(_wiki())).alias("plain_md5"))


@query(
    r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(w, '\{\{[^}]*\}\}', '', 'g'), '\[\[[^|\]]*\|([^\]]*)\]\]', '\1', 'g'),
    '\[\[([^\]]*)\]\]', '\1', 'g'), '\[https?://\S+\s+([^\]]+)\]', '\1', 'g'), '<[^>]+>', '', 'g'), '''{2,}', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13))) AS plain_md5
    FROM (SELECT doc_id, """
    + WIKI_SQL
    + " AS w FROM documents)"
)
def strip_wikitext(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(text.strip_wikitext(_wiki())).alias("plain_md5"))


@query("SELECT page_id, length(regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g')) AS n_text, md5(regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g')) AS text_md5 FROM pages")
def strip_html_pages(spark, sf_dir):
    bare = table(spark, sf_dir, "pages").select("page_id", text.strip_tags(text_or_empty("html")).alias("t"))
    return bare.select("page_id", F.length("t").cast("long").alias("n_text"), F.md5("t").alias("text_md5"))


def _routed(spark, sf_dir):
    docs = documents(spark, sf_dir)
    source_dir = F.when(F.col("doc_id") % 4 == 0, "court").when(F.col("doc_id") % 4 == 1, "kolzchut").when(F.col("doc_id") % 4 == 2, "wikisource_laws").otherwise("knesset")
    return docs.select("doc_id", source_dir.alias("source_dir"), F.col("lang").alias("title"), "text", F.when(F.col("doc_id") % 8 < 4, F.concat(F.lit("[[x|"), TEXT(), F.lit("]]"))).alias("wikitext"))


@query(
    f"""SELECT doc_id, source, title, md5(t) AS text_md5 FROM (
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'court' WHEN 1 THEN 'kolzchut' ELSE 'wikisource' END AS source, coalesce(lang, '') AS title, CASE WHEN doc_id % 4 = 0
      THEN {CLEAN.format("regexp_replace(array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), chr(10)), chr(10) || '{3,}', chr(10) || chr(10), 'g')")}
      ELSE {CLEAN.format("replace(replace(replace(regexp_replace(CASE WHEN doc_id % 8 < 4 THEN '[[x|' || coalesce(text, '') || ']]' ELSE coalesce(text, '') END, '<LINK>', '<KEEP>', 'g'), '''''''', ''), '''''', ''), '==', '')".replace("<LINK>", chr(92) + "[" + chr(92) + "[(?:[^|" + chr(92) + "]]*" + chr(92) + "|)?([^" + chr(92) + "]]*)" + chr(92) + "]" + chr(92) + "]").replace("<KEEP>", chr(92) + "1"))} END AS t
    FROM documents WHERE doc_id % 4 <> 3) WHERE t <> ''"""
)
def route_documents(spark, sf_dir):
    return text.clean_documents(_routed(spark, sf_dir)).select("doc_id", "source", "title", F.md5("text").alias("text_md5"))


@query(
    """SELECT s_suppkey AS law_id, md5('שם החוק: ' || s_name || chr(10) || 'סוג: ' || s_nationkey || CASE WHEN s_acctbal > 0 THEN chr(10) || 'תאריך פרסום: ' || CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) ELSE '' END || chr(10) || 'StatusDesc: x' || s_suppkey) AS text_md5 FROM supplier"""
)
def law_records(spark, sf_dir):
    laws = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Id"), F.col("s_name").alias("Name"), F.col("s_nationkey").alias("TypeDesc"), F.when(F.col("s_acctbal") > 0, F.floor("s_acctbal").cast("long")).alias("LastUpdatedDate"), F.concat(F.lit("x"), F.col("s_suppkey")).alias("StatusDesc")
    )
    return text.law_text(laws).select(F.col("law_id").cast("long").alias("law_id"), F.md5("text").alias("text_md5"))


# ------------------------------------------------------------------ personal data

_SCRUB_SQL = "coalesce(text, '')"
for _pattern, _to in scrubbing.SCRUB_RULES:
    _SCRUB_SQL = f"regexp_replace({_SCRUB_SQL}, '{_pattern.replace('(?U)', '')}', '{_to}', 'g')"


@query(f"SELECT doc_id, md5({_SCRUB_SQL}) AS scrubbed_md5 FROM documents")
def pii_scrub(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.md5(scrubbing.scrub(TEXT())).alias("scrubbed_md5"))


@query(f"SELECT source, count(*) AS total, count(*) FILTER (WHERE {_SCRUB_SQL} <> coalesce(text, '')) AS modified FROM documents GROUP BY source")
def pii_counts(spark, sf_dir):
    return scrubbing.scrub_stats(documents(spark, sf_dir))


@query(f"SELECT doc_id, md5(CASE WHEN contains(coalesce(text, ''), '[שם]') THEN coalesce(text, '') ELSE {_SCRUB_SQL} END) AS scrubbed_md5 FROM documents")
def pii_skip_marked(spark, sf_dir):
    return scrubbing.scrub_documents(documents(spark, sf_dir), skip_marked=True).select("doc_id", F.md5("text").alias("scrubbed_md5"))


# ------------------------------------------------------------------ signals and filters

_T = "coalesce(text, '')"
_WORDS = f"list_filter(regexp_split_to_array({_T}, '\\s+'), lambda x: x <> '')"
_LINES = f"string_split({_T}, chr(10))"
_STRIPPED = "trim(x, ' ' || chr(9) || chr(13))"
SIGNAL_SQL = {
    "word_count": f"CAST(len({_WORDS}) AS BIGINT)",
    "alpha_ratio": rf"CASE WHEN {_T} = '' THEN 0.0 ELSE length(regexp_replace({_T}, '[^\pL]+', '', 'g')) / length({_T}) END",
    "hebrew_ratio": rf"CASE WHEN length(regexp_replace({_T}, '[^a-zA-Z\x{{0590}}-\x{{06FF}}]+', '', 'g')) = 0 THEN 0.0 ELSE length(regexp_replace({_T}, '[^\x{{0590}}-\x{{05FF}}]+', '', 'g')) / length(regexp_replace({_T}, '[^a-zA-Z\x{{0590}}-\x{{06FF}}]+', '', 'g')) END",
    "latin_ratio": rf"CASE WHEN length(regexp_replace({_T}, '[^a-zA-Z\x{{C0}}-\x{{24F}}\x{{0590}}-\x{{06FF}}]+', '', 'g')) = 0 THEN 0.0 ELSE length(regexp_replace({_T}, '[^a-zA-Z\x{{C0}}-\x{{24F}}]+', '', 'g')) / length(regexp_replace({_T}, '[^a-zA-Z\x{{C0}}-\x{{24F}}\x{{0590}}-\x{{06FF}}]+', '', 'g')) END",
    "word_repetition": f"(list_transform([{_WORDS}], lambda w: CASE WHEN len(w) < 5 THEN 0.0 ELSE least((len(w) - 4 - len(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))) * 5.0 / len(w), 1.0) END))[1]",
    "duplicate_lines": f"CASE WHEN length(replace({_T}, chr(10), '')) = 0 THEN 0.0 ELSE (length(array_to_string(list_filter({_LINES}, lambda x: {_STRIPPED} <> ''), '')) - length(array_to_string(list_distinct(list_filter({_LINES}, lambda x: {_STRIPPED} <> '')), ''))) / length(replace({_T}, chr(10), '')) END",
    "short_lines": f"CASE WHEN len(list_filter({_LINES}, lambda x: {_STRIPPED} <> '')) = 0 THEN 1.0 ELSE len(list_filter({_LINES}, lambda x: {_STRIPPED} <> '' AND length({_STRIPPED}) < 30)) / len(list_filter({_LINES}, lambda x: {_STRIPPED} <> '')) END",
    "boilerplate": f"CASE WHEN {_T} = '' THEN 0.0 ELSE least(CAST(list_sum(list_transform(list_filter({_LINES}, lambda x: regexp_full_match(x, '[-_=]{{3,}}')), lambda x: length(x))) AS DOUBLE) / length({_T}), 1.0) END",
}
SIGNAL_SQL["boilerplate"] = f"CASE WHEN {_T} = '' THEN 0.0 ELSE least((2 * length({_T}) - length(regexp_replace({_T}, '(?m)^[-_=]{{3,}}$', '', 'g')) - length(regexp_replace({_T}, '(?m)^\\s*\\d+\\s*$', '', 'g'))) / length({_T}), 1.0) END"


def _signal(name: str, column: Callable[[], Column]) -> None:
    def run(spark, sf_dir):
        x = column()
        return documents(spark, sf_dir).select("doc_id", x.cast("long").alias(name) if name == "word_count" else ratio(x, name))

    run.__name__ = f"signal_{name}"
    query(f"SELECT doc_id, {SIGNAL_SQL[name] if name == 'word_count' else f'round({SIGNAL_SQL[name]}, 6)'} AS {name} FROM documents")(run)


for _name in ("word_count", "alpha_ratio", "hebrew_ratio", "word_repetition", "duplicate_lines", "short_lines", "boilerplate"):
    _signal(_name, lambda name=_name: signals.signals(TEXT(), HEBREW_PROFILE)[name])
_signal("latin_ratio", lambda: signals.script_ratio(TEXT(), LATIN_PROFILE))


def _reason_sql(script: str) -> str:
    s = SIGNAL_SQL
    return f"""CASE WHEN {s['word_count']} < 100 THEN 'min_length' WHEN {s['alpha_ratio']} < 0.4 THEN 'alpha_ratio' WHEN {s[script]} < 0.5 THEN '{script}'
    WHEN {s['word_repetition']} > 0.5 THEN 'word_repetition' WHEN {s['duplicate_lines']} > 0.3 THEN 'duplicate_lines' WHEN {s['short_lines']} > 0.8 THEN 'short_lines'
    WHEN {s['boilerplate']} > 0.4 THEN 'boilerplate' END"""


@query(f"SELECT doc_id, {_reason_sql('hebrew_ratio')} AS reject_reason FROM documents")
def filter_reason(spark, sf_dir):
    return signals.with_reason(documents(spark, sf_dir), HEBREW_PROFILE).select("doc_id", "reject_reason")


@query(f"SELECT doc_id, {_reason_sql('latin_ratio')} AS reject_reason FROM documents")
def filter_reason_latin(spark, sf_dir):
    return signals.with_reason(documents(spark, sf_dir), LATIN_PROFILE).select("doc_id", "reject_reason")


@query(f"SELECT source, coalesce(reason, 'kept') AS reason, count(*) AS documents FROM (SELECT source, {_reason_sql('hebrew_ratio')} AS reason FROM documents) GROUP BY ALL")
def filter_stats(spark, sf_dir):
    return signals.filter_stats(documents(spark, sf_dir), HEBREW_PROFILE)


@query(f"SELECT source, coalesce(reason, 'kept') AS reason, count(*) AS documents FROM (SELECT source, {_reason_sql('latin_ratio')} AS reason FROM documents) GROUP BY ALL")
def filter_stats_latin(spark, sf_dir):
    return signals.filter_stats(documents(spark, sf_dir), LATIN_PROFILE)


@query("SELECT CASE WHEN length(text) >= 200 THEN 'kept' ELSE 'skipped' END AS outcome, count(*) AS documents FROM (SELECT coalesce(text, '') AS text FROM documents) GROUP BY 1")
def length_gate(spark, sf_dir):
    kept = F.when(F.length(TEXT()) >= 200, "kept").otherwise("skipped")
    return table(spark, sf_dir, "documents").groupBy(kept.alias("outcome")).agg(F.count("*").alias("documents"))


# ------------------------------------------------------------------ duplicates

_NORM = r"lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')))"


@query(f"SELECT source, doc_id, sha256({_NORM}) AS text_hash, row_number() OVER (PARTITION BY source, {_NORM} ORDER BY doc_id) > 1 AS is_duplicate FROM documents")
def exact_dedup(spark, sf_dir):
    return dedup.exact_marks(documents(spark, sf_dir))


@query(f"SELECT source, count(*) AS total, count(*) - count(DISTINCT {_NORM}) AS exact_dups, CAST(0 AS BIGINT) AS near_dups, count(DISTINCT {_NORM}) AS kept FROM documents GROUP BY source")
def exact_dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(documents(spark, sf_dir), near=False)


@query()
def near_dedup(spark, sf_dir):
    return dedup.near_marks(documents(spark, sf_dir))


@query()
def dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(documents(spark, sf_dir))


# ------------------------------------------------------------------ training rows

_FRACTION = "CAST(('0x' || substr(md5(source || '/' || doc_id), 1, 8)) AS BIGINT) / 4294967295.0"
_SPLIT = f"CASE WHEN {_FRACTION} < 0.02 THEN 'eval' ELSE 'train' END"
_WEIGHT = "CASE source WHEN 'src1' THEN 5 WHEN 'src2' THEN 5 ELSE 1 END"


@query(f"SELECT doc_id, {_SPLIT} AS split FROM documents")
def split(spark, sf_dir):
    return training.with_split(table(spark, sf_dir, "documents").select("doc_id", "source")).select("doc_id", "split")


@query(f"SELECT doc_id, split, CAST(unnest(range(1, CASE WHEN split = 'train' THEN {_WEIGHT} ELSE 1 END + 1)) AS INTEGER) AS copy FROM (SELECT *, {_SPLIT} AS split FROM documents)")
def upsample(spark, sf_dir):
    docs = training.with_split(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return training.upsample(docs, config=FORMAT).select("doc_id", "split", "copy")


@query(
    f"""SELECT source, doc_id, copy, md5(concat_ws('/', '42', source, doc_id, copy)) AS place
    FROM (SELECT source, doc_id, CAST(unnest(range(1, {_WEIGHT} + 1)) AS INTEGER) AS copy FROM documents WHERE {_SPLIT} = 'train') ORDER BY place, source, doc_id, copy"""
)
def train_shuffle(spark, sf_dir):
    docs = training.with_split(table(spark, sf_dir, "documents").select("doc_id", "source"))
    rows = training.upsample(docs.where("split = 'train'"), config=FORMAT)
    return training.shuffled(rows, "source", "doc_id", "copy").select("source", "doc_id", "copy", "place")


_STATS = f"""SELECT source, count(*) AS raw_docs, count(*) FILTER (WHERE split = 'train') AS train_docs, count(*) FILTER (WHERE split = 'train') * {_WEIGHT} AS train_rows,
 count(*) FILTER (WHERE split = 'eval') AS eval_docs, CAST({_WEIGHT} AS INTEGER) AS upsample FROM (SELECT *, {_SPLIT} AS split FROM documents) GROUP BY source"""


@query(f"WITH e AS ({_STATS}) SELECT source, raw_docs, train_docs, train_rows, eval_docs, upsample FROM e UNION ALL SELECT NULL, sum(raw_docs)::BIGINT, sum(train_docs)::BIGINT, sum(train_rows)::BIGINT, sum(eval_docs)::BIGINT, NULL FROM e")
def split_stats(spark, sf_dir):
    return training.split_stats(training.with_split(table(spark, sf_dir, "documents").select("doc_id", "source")), config=FORMAT)


@query("SELECT conv_id, md5(string_agg(CASE role WHEN 'user' THEN '[INST] ' || coalesce(text, '') || ' [/INST]' WHEN 'assistant' THEN coalesce(text, '') || '</s>' ELSE '' END, '' ORDER BY turn, role, text)) AS chat_md5 FROM conversations GROUP BY conv_id")
def chat_template(spark, sf_dir):
    return training.chat_conversations(table(spark, sf_dir, "conversations")).select("conv_id", F.md5("text").alias("chat_md5"))


@query("SELECT conv_id, turn, md5(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13))) AS answer_md5 FROM conversations WHERE role = 'assistant'")
def extract_answer(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return said.select("conv_id", "turn", F.md5(training.answer_of(F.concat(F.lit("[INST] a [/INST] b [/INST]"), TEXT()))).alias("answer_md5"))


@query(f"SELECT doc_id, CAST(floor((sum({SIGNAL_SQL['word_count']} + 1) OVER (PARTITION BY source ORDER BY doc_id) - 1) / 2048) AS BIGINT) AS sequence FROM documents")
def pack_sequences(spark, sf_dir):
    sized = documents(spark, sf_dir).select("doc_id", "source", (signals.word_count(TEXT()) + 1).cast("long").alias("tokens"))
    return training.pack_in_order(sized, "tokens", "doc_id").select("doc_id", "sequence")


@query(r"SELECT doc_id, substr(regexp_replace(substr(coalesce(text, ''), 1, 120), '[^\pL\pN _-]', '_', 'g'), 1, 80) || '_' || substr(CAST(doc_id AS VARCHAR), 1, 8) || '.txt' AS file_name FROM documents")
def export_names(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", training.export_name(F.substring(TEXT(), 1, 120), F.col("doc_id")).alias("file_name"))


# ------------------------------------------------------------------ statistics and samples


@query(
    f"""WITH d AS (SELECT source, length(coalesce(text, '')) AS c, {SIGNAL_SQL['word_count']} AS w FROM documents),
    a AS (SELECT source, count(*) AS n, list(c ORDER BY c) AS cs, list(w ORDER BY w) AS ws, sum(c) AS sc, sum(w) AS sw FROM d GROUP BY source)
    SELECT source, n AS documents, cs[n // 2 + 1] AS median_chars, cs[n // 10 + 1] AS p10_chars, cs[n * 9 // 10 + 1] AS p90_chars, CAST(sc // n AS BIGINT) AS mean_chars, ws[n // 2 + 1] AS median_words, CAST(sw // n AS BIGINT) AS mean_words FROM a"""
)
def corpus_quantiles(spark, sf_dir):
    return stats.corpus_stats(documents(spark, sf_dir))


_PLACE = "row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || '#42'), doc_id)"


@query(f"SELECT source, doc_id, CAST(sample_rank AS INTEGER) AS sample_rank FROM (SELECT source, doc_id, {_PLACE} AS sample_rank FROM documents) WHERE sample_rank <= 10")
def sample_k_per_source(spark, sf_dir):
    return stats.sample_per_source(table(spark, sf_dir, "documents").select("source", "doc_id"), 10)


@query(
    f"""WITH r AS (SELECT source, doc_id, {SIGNAL_SQL['word_count']} AS words, {_PLACE} AS place FROM documents),
    t AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY place) AS taken FROM r WHERE place <= 10 AND words >= 200)
    SELECT CAST(row_number() OVER (ORDER BY md5(doc_id || '#43'), doc_id) AS INTEGER) AS list_order, source, doc_id FROM t WHERE taken <= 5"""
)
def qa_sample_list(spark, sf_dir):
    return qa.sample_list(documents(spark, sf_dir), 5)


@query(f"SELECT 'whitespace' AS tokenizer, count(*) AS documents, CAST(sum(w) AS BIGINT) AS tokens, round(sum(c) / sum(w), 6) AS chars_per_token, 1.0::DOUBLE AS tokens_per_word FROM (SELECT length(coalesce(text, '')) AS c, {SIGNAL_SQL['word_count']} AS w FROM documents)")
def tokenizer_stats(spark, sf_dir):
    return stats.tokenizer_stats(documents(spark, sf_dir))


@query(
    f"""WITH s AS (SELECT substr(coalesce(text, ''), 1, 5000) AS t FROM (SELECT text, {_PLACE} AS place FROM documents) WHERE place <= 166),
    n AS (SELECT count(*) AS documents, sum(length(t)) AS c, sum({SIGNAL_SQL['word_count'].replace("coalesce(text, '')", 't')}) AS w, sum(strlen(t)) AS b FROM s), k AS (SELECT 'whitespace' AS tokenizer, w AS tokens FROM n UNION ALL SELECT 'bytes', b FROM n UNION ALL SELECT 'characters', c FROM n)
    SELECT tokenizer, documents, CAST(tokens AS BIGINT) AS tokens, round(c / tokens, 6) AS chars_per_token, round(tokens / w, 6) AS tokens_per_word, CAST(floor(tokens / documents * (SELECT count(*) FROM documents)) AS BIGINT) AS estimated_tokens FROM k CROSS JOIN n"""
)
def tokenizer_analysis(spark, sf_dir):
    """Three tokenizers that need no download, and one that can't be loaded."""

    def lost():
        raise OSError("no such model")

    kinds = {"whitespace": lambda: signals.word_count, "lost": lost, "bytes": lambda: F.octet_length, "characters": lambda: F.length}
    return stats.tokenizer_table(documents(spark, sf_dir), kinds)[0]


@query("SELECT 'documents' AS stage, source, count(*) AS documents FROM documents GROUP BY source UNION ALL SELECT 'long', source, count(*) FROM documents WHERE length(coalesce(text, '')) >= 200 GROUP BY source")
def stage_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return stats.stage_counts({"documents": docs, "long": store.long_enough(docs, 200)})


# ------------------------------------------------------------------ question-answer building


def _entries(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("list_order"))


@query("SELECT doc_id, list_order, md5(substr(coalesce(text, ''), 1, 6000)) AS head_md5 FROM (SELECT *, doc_id AS list_order FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) ORDER BY doc_id LIMIT 10)")
def qa_next(spark, sf_dir):
    done = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    found = qa.next_work(_entries(spark, sf_dir), done, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "list_order", F.md5("text").alias("head_md5"))


@query("SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS processed, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS remaining, (SELECT count(*) FROM conversations) AS pairs")
def qa_status(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return qa.work_status(_entries(spark, sf_dir), done, table(spark, sf_dir, "conversations"))


@query("SELECT DISTINCT doc_id FROM (SELECT doc_id FROM labels WHERE quality = 1 UNION ALL SELECT doc_id FROM labels WHERE toxic = 0)")
def qa_mark_done(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return qa.mark_done(labels.where("quality = 1").select("doc_id"), labels.where("toxic = 0").select("doc_id"))


@query("SELECT doc_id, substr(md5(source || '/' || doc_id || '.json'), 1, 12) AS work_key FROM documents")
def work_keys(spark, sf_dir):
    path = F.concat(training.document_id(F.col("source"), F.col("doc_id")), F.lit(".json"))
    return table(spark, sf_dir, "documents").select("doc_id", qa.work_key(path).alias("work_key"))


_HEAD, _TAIL = (part.replace("'", "''") for part in qa.PROMPT.replace("{{", "{").replace("}}", "}").split("{text}"))


@query(f"SELECT doc_id, md5('{_HEAD}' || CASE WHEN length(coalesce(text, '')) > 8000 THEN substr(text, 1, 8000) || '...' ELSE coalesce(text, '') END || '{_TAIL}') AS prompt_md5 FROM documents")
def prompt_build(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(qa.prompt_for(TEXT())).alias("prompt_md5"))


def _reply() -> Column:
    """Replies of all kinds made from documents: fenced, marked json, malformed, with short answers."""
    question, answer = F.concat(F.lit("  Who "), F.col("source"), F.lit("?")), F.substring(F.regexp_replace(TEXT(), r"[^a-zA-Z ]", ""), 1, 30)
    good = F.to_json(F.array(F.struct(question.alias("question"), answer.alias("answer")), F.struct(F.lit("").alias("question"), answer.alias("answer")), F.struct(question.alias("question"), F.lit("short").alias("answer"))))
    kind = F.col("doc_id") % 4
    return F.when(kind == 0, good).when(kind == 1, F.concat(F.lit("```json\n"), good, F.lit("\n```"))).when(kind == 2, F.concat(F.lit("json "), good)).otherwise("no json")


@query(
    r"""SELECT doc_id, 'Who ' || source || '?' AS question, trim(a) AS answer FROM (
    SELECT doc_id, source, substr(regexp_replace(coalesce(text, ''), '[^a-zA-Z ]', '', 'g'), 1, 30) AS a FROM documents WHERE doc_id % 4 <> 3) WHERE length(trim(a)) > 20"""
)
def parse_qa(spark, sf_dir):
    replies = table(spark, sf_dir, "documents").select("doc_id", _reply().alias("reply"))
    return qa.parse_replies(replies).select("doc_id", "question", "answer")


@query(
    f"""SELECT doc_id, (['malformed', 'limited', 'blocked', 'failed', 'ok'])[k + 1] AS outcome, k IN (0, 2, 4) AS done FROM (
    SELECT doc_id, length('{_HEAD}' || CASE WHEN length(coalesce(text, '')) > 8000 THEN substr(text, 1, 8000) || '...' ELSE coalesce(text, '') END || '{_TAIL}') % 5 AS k FROM documents)"""
)
def model_calls(spark, sf_dir):
    """Prompts through a deterministic stand-in for a model, with every outcome."""

    def load():
        def ask(prompt: str) -> str:
            kind = len(prompt) % 5
            if kind in (1, 2, 3):
                raise RuntimeError({1: "429 quota", 2: "safety block", 3: "lost"}[kind])
            return '[{"question": "q", "answer": "a"}]' if kind else "no json"

        return ask

    prompts = documents(spark, sf_dir).select("doc_id", qa.prompt_for(TEXT()).alias("prompt"))
    return qa.call_model(prompts, load).select("doc_id", "outcome", "done")


# ------------------------------------------------------------------ spans


@query(
    """WITH o AS (SELECT l_orderkey AS doc_id, l_partkey % 200 AS s, l_partkey % 200 + l_quantity::INTEGER % 20 AS e FROM lineitem),
    d AS (SELECT DISTINCT * FROM o), m AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM d),
    g AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s, e) AS island FROM m)
    SELECT doc_id, CAST(min(s) AS INTEGER) AS s, CAST(max(e) AS INTEGER) AS e FROM g GROUP BY doc_id, island"""
)
def span_merge(spark, sf_dir):
    start = (F.col("l_partkey") % 200).cast("int")
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.struct(start.alias("s"), (start + F.col("l_quantity").cast("int") % 20).alias("e")).alias("x"))
    merged = own.groupBy("doc_id").agg(F.collect_list("x").alias("x")).select("doc_id", F.explode(spans.merge_spans(F.col("x"))).alias("x"))
    return merged.select("doc_id", "x.s", "x.e")


_LABEL = "CASE (event_id * 7 + event_id // 5) % 4 WHEN 0 THEN 'B-PER' WHEN 1 THEN 'I-PER' WHEN 2 THEN 'I-PER' ELSE 'O' END"


@query(
    f"""WITH t AS (SELECT user_id AS doc_id, event_id AS idx, event_id * 10 AS s, event_id * 10 + 5 AS e, {_LABEL} AS label FROM events),
    g AS (SELECT *, sum(CASE WHEN label = 'I-PER' THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY idx) AS island FROM t)
    SELECT doc_id, CAST(min(s) AS INTEGER) AS s, CAST(max(e) AS INTEGER) AS e FROM g WHERE label <> 'O' GROUP BY doc_id, island HAVING bool_or(label = 'B-PER')"""
)
def bio_decode(spark, sf_dir):
    place = F.col("event_id")
    kind = (place * 7 + F.floor(place / 5)) % 4
    label = F.when(kind == 0, "B-PER").when(kind <= 2, "I-PER").otherwise("O")
    tokens = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), place.alias("idx"), (place * 10).alias("start"), (place * 10 + 5).alias("end"), label.alias("label"))
    return spans.decode_bio(tokens)


@query(
    f"""SELECT doc_id, CAST(k * 110 AS INTEGER) AS window_start, CAST(least(k * 110 + 510, n) AS INTEGER) AS window_end FROM (SELECT doc_id, n, unnest(range(0, CAST(ceil(greatest(n - 510, 0) / 110) AS BIGINT) + 1)) AS k
    FROM (SELECT doc_id, {SIGNAL_SQL['word_count']} AS n FROM documents) WHERE n > 0)"""
)
def token_windows(spark, sf_dir):
    sized = documents(spark, sf_dir).select("doc_id", signals.word_count(TEXT()).alias("n"))
    return spans.token_windows(sized, "n").select("doc_id", "window_start", "window_end")


@query("SELECT doc_id, md5(CASE WHEN length(coalesce(text, '')) >= 12 THEN CASE WHEN length(trim(substr(text, 3, 5))) >= 2 THEN substr(text, 1, 2) || '[שם]' ELSE substr(text, 1, 7) END || substr(text, 8) ELSE coalesce(text, '') END) AS text_md5 FROM documents")
def span_replace(spark, sf_dir):
    one = F.when(F.length(TEXT()) >= 12, F.from_json(F.lit('[{"s": 2, "e": 5}, {"s": 4, "e": 7}, {"s": 9, "e": 10}]'), spans.SPANS)).otherwise(F.array().cast(spans.SPANS))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(spans.replace_spans(TEXT(), spans.merge_spans(one))).alias("text_md5"))


_NAMES_SQL = f"CASE WHEN contains(coalesce(text, ''), '[שם]') THEN coalesce(text, '') ELSE regexp_replace({_SCRUB_SQL}, '\\b[A-Z][a-z]+ [A-Z][a-z]+\\b', '[שם]', 'g') END"


@query(f"SELECT doc_id, md5({_NAMES_SQL}) AS text_md5 FROM documents")
def name_scrub(spark, sf_dir):
    """Name spans of a stand-in model (capitalised word pairs), replaced."""

    def load():
        import re

        pair = re.compile(r"\b[A-Z][a-z]+ [A-Z][a-z]+\b", re.ASCII)
        return lambda texts: [[m.span() for m in pair.finditer(t)] for t in texts]

    return spans.scrub_names(documents(spark, sf_dir).select("doc_id", "text"), load).select("doc_id", F.md5("text").alias("text_md5"))


@query(
    f"""SELECT doc_id, CASE WHEN contains(coalesce(text, ''), '[שם]') THEN 'done' WHEN bad THEN 'failed' ELSE 'scrubbed' END AS outcome, md5(CASE WHEN bad THEN coalesce(text, '') ELSE {_NAMES_SQL} END) AS text_md5
    FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '[שם] ' || coalesce(text, '') ELSE text END AS text FROM documents) CROSS JOIN LATERAL (SELECT length({_SCRUB_SQL}) % 7 = 0 AS bad)"""
)
def name_scrub_slices(spark, sf_dir):
    """Names in slices of rows, with texts that are marked before and a stand-in model that fails on some."""

    def load():
        import re

        pair = re.compile(r"\b[A-Z][a-z]+ [A-Z][a-z]+\b", re.ASCII)

        def model(texts):
            if any(len(t) % 7 == 0 for t in texts):
                raise RuntimeError("the model gave up")
            return [[m.span() for m in pair.finditer(t)] for t in texts]

        return model

    docs = documents(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("[שם] "), TEXT())).otherwise(F.col("text")).alias("text"))
    return spans.scrub_in_slices(docs, load, "doc_id").select("doc_id", "outcome", F.md5("text").alias("text_md5"))


# ------------------------------------------------------------------ store


@query("SELECT md5(CAST(user_id AS VARCHAR)) AS store_key, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def upsert_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(store.store_key(F.col("user_id")).alias("store_key"), "event_id", "event_type")
    return store.latest(events, "store_key", "event_id")


@query(
    """WITH l AS (SELECT lang AS title, 0 AS listing, doc_id AS ord FROM documents UNION ALL SELECT source, 1, doc_id FROM documents UNION ALL SELECT lang, 2, doc_id FROM documents)
    SELECT title, listing, min(ord) AS ord FROM l GROUP BY title, listing QUALIFY row_number() OVER (PARTITION BY title ORDER BY listing) = 1"""
)
def title_union(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    listing = lambda c: docs.select(F.col(c).alias("title"), F.col("doc_id").alias("ord"))
    return store.union_titles(listing("lang"), listing("source"), listing("lang"))


@query("SELECT DISTINCT p_name AS title FROM part WHERE starts_with(p_name, 'cold ') OR starts_with(p_name, 'small ')")
def title_prefixes(spark, sf_dir):
    return store.titles_with_prefix(table(spark, sf_dir, "part").select(F.col("p_name").alias("title")), ["cold ", "small "])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark, sf_dir):
    return store.pending(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT page_id, 'https://example.org/wiki/' || replace(url, ' ', '_') AS url FROM pages WHERE length(coalesce(html, '')) >= 50 AND NOT contains(url, '\"')")
def page_urls(spark, sf_dir):
    docs = store.long_enough(table(spark, sf_dir, "pages"), 50, "html").where(~F.contains("url", F.lit('"')))
    return docs.select("page_id", store.page_url("https://example.org/wiki/", F.col("url")).alias("url"))


@query(
    """WITH k AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents WHERE length(coalesce(text, '')) >= 100)
    SELECT 'gc_' || CASE doc_id % 3 WHEN 0 THEN 'j' || doc_id WHEN 1 THEN source || '/' || doc_id ELSE CAST(place AS VARCHAR) END AS store_id, CASE WHEN doc_id % 3 = 0 THEN 'j' || doc_id ELSE '' END AS judgment_id,
    lang AS title, CASE WHEN doc_id % 3 < 2 THEN source || '/' || doc_id END AS case_number, '' AS date, CAST(n_chars AS VARCHAR) AS court_type, '' AS district, '' AS subject, lang || '; ' || source AS judges, md5(text) AS text_md5, 'court_guychuk' AS source FROM k"""
)
def court_scan(spark, sf_dir):
    doc, kind = F.col("doc_id"), F.col("doc_id") % 3
    rows = table(spark, sf_dir, "documents").select(
        doc.alias("row_place"), F.when(kind == 0, F.concat(F.lit("j"), doc)).otherwise("").alias("judgment_id"), F.col("lang").alias("title"), F.when(kind < 2, F.concat_ws("/", "source", doc)).alias("name_number"),
        F.col("n_chars").cast("string").alias("court_type_label"), F.concat_ws("; ", "lang", "source").alias("judges_str"), F.col("text").alias("document_text"),
    )
    return records.court_judgments(rows, "row_place").withColumn("text_md5", F.md5("text")).drop("text")


@query(
    """WITH k AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents WHERE length(coalesce(text, '')) >= 200)
    SELECT 'sc_' || CASE WHEN doc_id % 4 < 3 THEN 'c' || doc_id ELSE CAST(place AS VARCHAR) END AS store_id, CASE WHEN doc_id % 4 < 2 THEN 'c' || doc_id END AS case_id, CASE WHEN doc_id % 4 = 2 THEN 'c' || doc_id ELSE '' END AS case_num,
    source AS case_name, lang AS title, CAST(n_chars AS VARCHAR) AS date, '' AS year, '' AS type, lang || ',' || source AS judges, '' AS parties, '' AS lawyers, '' AS court, lang AS division, md5(text) AS text_md5, 'court_supreme' AS source FROM k"""
)
def supreme_scan(spark, sf_dir):
    doc, kind = F.col("doc_id"), F.col("doc_id") % 4
    rows = table(spark, sf_dir, "documents").select(
        doc.alias("row_place"), F.when(kind < 2, F.concat(F.lit("c"), doc)).alias("case_id"), F.when(kind == 2, F.concat(F.lit("c"), doc)).otherwise("").alias("CaseNum"), F.lit("never read").alias("case_nbr"), F.col("source").alias("meta_case_nm"),
        F.col("lang").alias("html_title"), F.col("n_chars").cast("string").alias("meta_verdict_dt"), F.array("lang", "source").alias("meta_judge"), F.col("lang").alias("meta_mador_nm"), "text",
    )
    found = records.supreme_judgments(rows, "row_place")
    return found.select(*[F.array_join(c, ",").alias(c) if c in records.LISTS else c for c in found.columns if c != "text"], F.md5("text").alias("text_md5"))


@query("SELECT count(*) FILTER (WHERE length(coalesce(text, '')) >= 200) AS saved, count(*) FILTER (WHERE length(coalesce(text, '')) < 200) AS skipped FROM documents")
def supreme_scan_counts(spark, sf_dir):
    return records.skipped_short(table(spark, sf_dir, "documents"), 200, "text")


@query(
    r"""SELECT doc_id, lang || ' ' || source AS title, md5(w) AS wikitext_md5, md5(t) AS text_md5, lang || ',' || source AS categories, 'wikisource' AS source, 'https://example.org/wiki/' || lang || '_' || source AS url FROM (
    SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(w, '\{\{[^}]*\}\}', '', 'g'), '\[\[[^|\]]*\|([^\]]*)\]\]', '\1', 'g'),
    '\[\[([^\]]*)\]\]', '\1', 'g'), '\[https?://\S+\s+([^\]]+)\]', '\1', 'g'), '<[^>]+>', '', 'g'), '''{2,}', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS t
    FROM (SELECT doc_id, lang, source, """
    + WIKI_SQL
    + " AS w FROM documents WHERE doc_id % 5 <> 0)) WHERE length(t) >= 150"
)
def page_contents(spark, sf_dir):
    """Parse replies made from documents, some of them without a result."""
    wikitext, names = F.struct(_wiki().alias("*")), F.array(F.struct(F.col("lang").alias("*")), F.struct(F.col("source").alias("*")))
    good = F.to_json(F.struct(F.struct(wikitext.alias("wikitext"), names.alias("categories")).alias("parse")))
    replies = documents(spark, sf_dir).select("doc_id", F.concat_ws(" ", "lang", "source").alias("title"), F.when(F.col("doc_id") % 5 == 0, '{"error": {"code": "missing"}}').otherwise(good).alias("reply"))
    found = records.page_records(replies, "https://example.org/wiki/", "wikisource", 150)
    return found.select("doc_id", "title", F.md5("wikitext").alias("wikitext_md5"), F.md5("text").alias("text_md5"), F.array_join("categories", ",").alias("categories"), "source", "url")


@query(
    """SELECT CASE WHEN s_suppkey % 4 > 0 THEN CAST(s_suppkey AS VARCHAR) ELSE s_name END AS store_id, s_name AS title, md5('שם החוק: ' || s_name || chr(10) || 'StatusDesc: x' || s_suppkey) AS text_md5,
    '{"LawID":' || CASE WHEN s_suppkey % 4 > 0 THEN '"' || s_suppkey || '"' ELSE 'null' END || ',"Name":"' || s_name || '","StatusDesc":"x' || s_suppkey || '"}' AS raw_fields FROM supplier WHERE s_suppkey % 3 > 0"""
)
def law_documents(spark, sf_dir):
    key = F.col("s_suppkey")
    laws = table(spark, sf_dir, "supplier").select(F.when(key % 4 > 0, key.cast("string")).alias("LawID"), F.when(key % 3 > 0, F.col("s_name")).when(key % 2 > 0, F.lit("")).alias("Name"), F.concat(F.lit("x"), key).alias("StatusDesc"))
    return records.law_documents(laws).select("store_id", "title", F.md5("text").alias("text_md5"), "raw_fields")


@query(
    """WITH l AS (SELECT 1 AS range_no, doc_id AS ord, source AS title FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 2, doc_id, source || lang FROM documents UNION ALL SELECT -1, doc_id, lang FROM documents)
    SELECT title, min(range_no) AS range_no, min_by(ord, range_no * 1000000000 + ord) AS ord FROM l GROUP BY title"""
)
def listed_titles(spark, sf_dir):
    """Ranges 0 to 3 of a listing: the first is left out as there are titles, the third is the first that was read to its end."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), "lang", "source")
    part = lambda n, completed, title, rows=docs: rows.select(F.lit(n).alias("range_no"), F.lit(completed).alias("completed"), "ord", title.alias("title"))
    both = F.concat("source", "lang")
    listing = part(0, True, F.lit("never")).unionByName(part(1, False, F.col("source"), docs.where("ord % 2 = 0"))).unionByName(part(2, True, both)).unionByName(part(3, True, F.lit("behind the end")))
    return store.listed_titles(listing, docs.select("ord", F.col("lang").alias("title")))


@query("SELECT lang AS title FROM documents WHERE lang IS NOT NULL UNION SELECT source FROM documents WHERE source LIKE 'src1%' UNION SELECT c_mktsegment FROM customer ORDER BY title")
def sorted_titles(spark, sf_dir):
    """Listings and prefixes, one of which fails."""
    docs = table(spark, sf_dir, "documents")
    listings = {
        "languages": lambda: docs.where("lang IS NOT NULL").select(F.col("lang").alias("title")), "lost": lambda: table(spark, sf_dir, "no_such_table"),
        "prefix": lambda: store.titles_with_prefix(docs.select(F.col("source").alias("title")), ["src1"]), "segments": lambda: table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("title")),
    }
    return store.sorted_titles(spark, listings)[0]


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_index FROM documents QUALIFY row_index >= 100 AND row_index < 150")
def slice_rows(spark, sf_dir):
    return store.slice_rows(table(spark, sf_dir, "documents").select("doc_id"), 100, 150, "doc_id")


# ------------------------------------------------------------------ the whole


@query()
def full_pipeline(spark, sf_dir):
    """All steps with the Latin profile; ids and copies of the training rows."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return pipeline.run(docs, LATIN_PROFILE, config=FORMAT)["format"].select("doc_id", "source", "split", "copy")
