"""Question-answer building: sample lists, resumable work lists, prompts, replies and model calls."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.config import QaConfig
from corpusmill.functions.columns import strip, text_or_empty
from corpusmill.functions.signals import word_count
from corpusmill.operators.stats import sample_per_source, seeded_place
from corpusmill.operators.workers import bound_batches, give_back

# Fixed value: the instruction that asks for three question-answer pairs.
PROMPT = """אתה מומחה למשפט ישראלי. קרא את הטקסט המשפטי הבא וצור ממנו 3 זוגות של שאלה-תשובה בעברית.

כללים:
- השאלות צריכות להיות שאלות מעשיות שאזרח רגיל עשוי לשאול
- התשובות צריכות להיות מבוססות רק על הטקסט הנתון
- התשובות צריכות להיות ברורות, מפורטות ומדויקות
- כתוב בעברית בלבד

הטקסט:
{text}

החזר את התוצאה בפורמט JSON בלבד, ללא טקסט נוסף:
[
  {{"question": "השאלה כאן", "answer": "התשובה כאן"}},
  {{"question": "השאלה כאן", "answer": "התשובה כאן"}},
  {{"question": "השאלה כאן", "answer": "התשובה כאן"}}
]"""


def work_key(path: Column) -> Column:
    """The first 12 hex digits of a path's md5."""
    return F.substring(F.md5(path), 1, 12)


def sample_list(df: DataFrame, per_source: int, min_words: int = 200, source: str = "source", key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Twice the wanted number of each source drawn first, those with enough words kept, the first `per_source` taken, and
    all of them put in one seeded order: (list_order, source, key)."""
    drawn = sample_per_source(df.select(source, key, word_count(text_or_empty("text")).alias("words")), 2 * per_source, source, key, seed)
    long = drawn.where(F.col("words") >= min_words)
    taken = long.withColumn("taken", F.row_number().over(Window.partitionBy(source).orderBy("sample_rank"))).where(F.col("taken") <= per_source)
    order = F.row_number().over(Window.orderBy(seeded_place(F.col(key), seed + 1), key))  # the list is per_source rows a source
    return taken.select(order.alias("list_order"), source, key)


def next_work(entries: DataFrame, done: DataFrame, docs: DataFrame, n: int = 10, key: str = "doc_id", chars: int = 6000) -> DataFrame:
    """The first n listed documents that are not done, with the head of their text."""
    todo = entries.join(done, key, "left_anti").orderBy("list_order").limit(n)
    return todo.join(docs.select(key, F.substring(text_or_empty("text"), 1, chars).alias("text")), key)


def work_status(entries: DataFrame, done: DataFrame, pairs: DataFrame, key: str = "doc_id") -> DataFrame:
    """total, processed, remaining and pairs, one row."""
    total = entries.agg(F.count("*").alias("total"))
    left = entries.join(done, key, "left_anti").agg(F.count("*").alias("remaining"))
    made = pairs.agg(F.count("*").alias("pairs"))
    one = total.crossJoin(left).crossJoin(made)  # three single rows
    return one.select("total", (F.col("total") - F.col("remaining")).alias("processed"), "remaining", "pairs")


def mark_done(done: DataFrame, more: DataFrame) -> DataFrame:
    return done.unionByName(more.select(done.columns)).distinct()


def prompt_for(text: Column, chars: int = 8000, template: str = PROMPT) -> Column:
    """The prompt around a text; only longer texts are cut and get three dots."""
    head, tail = template.replace("{{", "{").replace("}}", "}").split("{text}")
    return F.concat(F.lit(head), F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("..."))).otherwise(text), F.lit(tail))


def unfenced(reply: Column) -> Column:
    """A reply without code fences and without the word json before its array."""
    text = strip(reply)
    opened = F.when(~F.startswith(text, F.lit("```")), text).when(F.contains(text, F.lit("\n")), F.regexp_replace(text, r"^[^\n]*\n", "")).otherwise(F.substr(text, F.lit(4)))
    closed = strip(F.regexp_replace(opened, r"```$", ""))
    return F.when(F.startswith(closed, F.lit("json")), strip(F.substr(closed, F.lit(5)))).otherwise(closed)


def parsed_pairs(reply: Column) -> Column:
    """The reply's array of (question, answer); null if it is no such array."""
    return F.from_json(unfenced(reply), "array<struct<question:string,answer:string>>")


def parse_replies(df: DataFrame, reply: str = "reply", min_answer: int = 20) -> DataFrame:
    """One row for each pair with a question and an answer longer than min_answer: the columns of df but the reply, question,
    answer and conversations. Malformed replies give no rows, nor do those in which a question or an answer is null (missing
    ones only count as empty)."""
    clean = F.transform(F.coalesce(parsed_pairs(F.col(reply)), F.array().cast("array<struct<question:string,answer:string>>")), lambda x: F.struct(strip(F.coalesce(x.question, F.lit(""))).alias("question"), strip(F.coalesce(x.answer, F.lit(""))).alias("answer")))
    good = F.filter(clean, lambda x: (x.question != "") & (F.length(x.answer) > min_answer))
    keyed = F.coalesce(F.from_json(unfenced(F.col(reply)), "array<map<string,string>>"), F.array().cast("array<map<string,string>>"))
    void = F.exists(keyed, lambda x: F.exists(F.map_entries(x), lambda e: e.key.isin("question", "answer") & e.value.isNull()))
    out = df.withColumn("_pair", F.explode(F.when(~void, good)))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return out.select(*[c for c in df.columns if c != reply], "_pair.question", "_pair.answer", F.array(turn("user", F.col("_pair.question")), turn("assistant", F.col("_pair.answer"))).alias("conversations"))


#: Prompts whose replies a worker collects before it passes them on.
ASKED = 256


def call_model(df: DataFrame, load: Callable[[], Callable[[str], str]], key: str = "doc_id", prompt: str = "prompt") -> DataFrame:
    """(key, prompt) -> (key, reply, outcome, done). `load` makes a client once for each task; the client may raise.

    Outcomes: ok and malformed (no JSON array) and blocked are done; limited (quota) and failed are tried again by the next
    run, which joins the work list with what is done.

    A worker holds one batch of a few MB and the rows of one slice of it, however many prompts a task has.
    """
    kind = df.schema[key].dataType.simpleString()
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = load()
        for batch in batches:
            for at in range(0, batch.num_rows, ASKED):
                rows, replies, outcomes = batch.slice(at, ASKED), [], []
                for text in rows.column(prompt):
                    try:
                        replies.append(ask(text.as_py()))
                        outcomes.append("ok")
                    except Exception as error:  # noqa: BLE001  a client may raise anything
                        said = str(error).lower()
                        replies.append(None)
                        outcomes.append("limited" if "429" in said or "quota" in said else "blocked" if "block" in said or "safety" in said else "failed")
                yield pa.RecordBatch.from_arrays([rows.column(key), pa.array(replies, pa.string()), pa.array(outcomes, pa.string())], [key, "reply", "outcome"])
        give_back()

    asked = df.select(key, prompt).mapInArrow(run, f"{key} {kind}, reply string, outcome string")
    outcome = F.when((F.col("outcome") == "ok") & parsed_pairs(F.col("reply")).isNull(), "malformed").otherwise(F.col("outcome"))
    return asked.withColumn("outcome", outcome).withColumn("done", F.col("outcome").isin("ok", "malformed", "blocked"))


def targets(config: QaConfig | None = None) -> dict[str, int]:
    return dict((config or QaConfig()).targets)
