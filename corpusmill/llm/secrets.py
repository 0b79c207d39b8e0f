"""Secret scan: base patterns, and dictionary-primed zstandard novelty for strings in sensitive contexts.

A candidate is a long unbroken string that is assigned, passed or quoted right behind a sensitive name. Its novelty is
the number of bytes by which it makes a zstandard frame longer, per character: the compressor is primed with the
dictionary of identifiers below, then sees the surrounding text, with and without the candidate. Names built from known
words, repeats of surrounding text and placeholders cost few bytes, or fewer than their characters in random order would;
random keys cost about one byte a character in any order. Other occurrences of the candidate are blanked out of the text
around it: a key that stands twice is no less a key. Candidates that stay incompressible are reported as kind "novel",
wherever else the text holds them too.

Texts are scanned in Python where they lie: no shuffle, and one pass.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import bound_batches, read_table

# The kinds in the order of their listing, the base patterns and their least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that are long enough
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Names that make a context sensitive, and what may stand between such a name and a candidate: the rest of its identifier,
#: any blanks and tabs, a few line ends, a separator. Only an identifier's start begins a match, so no long one is read twice.
_NAME = r"(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|signing[_-]?key|encryption[_-]?key|auth(?:orization)?|credentials?|bearer|client[_-]?secret|connection[_-]?string)"
_GAP = r"[ \t]*+(?:[^\S \t][ \t]*+){0,3}+"
SENSITIVE = re.compile(
    rf"""(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]*?{_NAME})[A-Za-z0-9_-]++["']?(?:{_GAP}(?:=>|:=|[:=,(]){_GAP}|(?=\s){_GAP}(?=["']))"""
    rf"""(?:(?:[Bb]earer|[Bb]asic)(?=\s){_GAP})?["']?([A-Za-z0-9+/_.=~!@#$%^&*-]{{12,}})"""
)
SENSITIVE_WORDS = ("pass", "pwd", "secret", "token", "key", "auth", "credential", "bearer", "connection")
#: Text on either side that a candidate is measured against, and novelty (bytes a character) from which it is reported.
CONTEXT = 256
NOVELTY = 0.72
#: A candidate must also cost this share of what its own characters cost in seeded random orders (their mean): in a random key
#: their order tells nothing, in a name it does.
SHUFFLED, SHUFFLES = 0.97, 3

# Identifiers of everyday code, the dictionary that the compressor is primed with.
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key secret_key private_key public_key client_id client_secret "
    "authorization bearer basic credential credentials username user email login logout session cookie signature certificate "
    "environment variable config configuration settings options default example placeholder changeme your_password_here "
    "your_api_key_here insert_token_here test_password dummy_secret sample_token xxxxxxxxxxxxxxxx 0000000000000000 1234567890 "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ os.environ getenv process.env request.headers response.json "
    "database connection_string hostname localhost 127.0.0.1 https://example.com http:// .example.org function return import "
    "from class public static void string integer boolean null None true false self this const let var def lambda async await "
    "get_password set_password reset_password forgot_password check_password hash_password verify_token refresh_token "
    "access_token id_token csrf_token token_type expires_in generate_token create_secret load_credentials read_file write_file "
    "application production development staging service account storage bucket region endpoint version number length index"
)
_DICTIONARY = None


def _compressor() -> zstandard.ZstdCompressor:
    global _DICTIONARY
    if _DICTIONARY is None:
        # As written in constants and in class names too: the least likely form first, as near matches are cheapest.
        forms = " ".join((IDENTIFIERS.title(), IDENTIFIERS.upper(), IDENTIFIERS))
        data = zstandard.ZstdCompressionDict(forms.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        _DICTIONARY = zstandard.ZstdCompressor(level=19, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
    return _DICTIONARY


def novelty(candidate: str, before: str, after: str) -> float:
    """Marginal compressed bytes of a candidate within its surroundings, per byte of the candidate."""
    compress, own = _compressor().compress, candidate.encode()
    around = (before + after).encode()
    return max(0, len(compress(around + own)) - len(compress(around))) / len(own)


def is_novel(candidate: str, before: str, after: str, least: float = NOVELTY) -> bool:
    """Whether a candidate is as incompressible as asked, and about as much as its characters in random order."""
    own = novelty(candidate, before, after)
    if own < least:
        return False
    shuffled = ("".join(random.Random(k).sample(candidate, len(candidate))) for k in range(SHUFFLES))
    return own >= SHUFFLED * sum(novelty(x, before, after) for x in shuffled) / SHUFFLES


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches, by start, then kind as listed."""
    low = text.lower()  # only a filter; what it says about characters beyond ASCII doesn't matter
    found = []
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


def _places(text: str, own: str) -> Iterator[int]:
    at = text.find(own)
    while at >= 0:
        yield at
        at = text.find(own, at + len(own))


def novel_spans(text: str, base: list[tuple[int, int, str]], least: float = NOVELTY) -> list[tuple[int, int, str]]:
    """Incompressible strings in sensitive contexts that overlap no base span."""
    low = text.lower()
    if not any(k in low for k in SENSITIVE_WORDS):
        return []
    found, seen = [], set()
    for m in SENSITIVE.finditer(text):
        s, e = m.span(1)
        own = m[1]
        if own in seen or any(a < e and s < b for a, b, _ in base) or len(set(own)) < 6 or not (any(c.isdigit() for c in own) or (own.lower() != own and own.upper() != own)):
            continue
        gap = " " * len(own)  # as long, so that the context's bounds stay where they are
        before = text[max(0, s - CONTEXT - len(own)) : s].replace(own, gap)[-CONTEXT:]
        after = text[e : e + CONTEXT + len(own)].replace(own, gap)[:CONTEXT]
        if is_novel(own, before, after, least):
            seen.add(own)
            found += [(s, e, "novel"), *((a, a + len(own), "novel") for a in _places(text, own))]
    # Of overlapping spans the first stays, and the longest of those that start together.
    out, at, covers = [], 0, 0
    for a, b, kind in sorted(set(found), key=lambda x: (x[0], -x[1])):
        while covers < len(base) and base[covers][1] <= a:
            covers += 1
        if a >= at and not any(x < b and a < y for x, y, _ in base[covers:]):
            out.append((a, b, kind))
            at = b
    return out


def _scan(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, novel = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                own = base_spans(text)
                base.append([{"kind": k, "s": s, "e": e} for s, e, k in own])
                novel.append([{"kind": k, "s": s, "e": e} for s, e, k in novel_spans(text, own, least)])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(base, kind), pa.array(novel, kind)], ["id", "base", "novel"])

    return run


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_novelty: float = NOVELTY) -> DataFrame:
    """Secrets of each row: id_col, base and novel, arrays of (kind, s, e) by start; offsets count code points.

    Null and empty texts have none. Repeated rows, null ids and ties are rows like others; an empty table gives no rows.
    Other columns play no part.
    """
    bound_batches(df.sparkSession)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    spans = "array<struct<kind:string,s:int,e:int>>"
    return docs.mapInArrow(_scan(least_novelty), f"id {docs.schema['id'].dataType.simpleString()}, base {spans}, novel {spans}").withColumnRenamed("id", id_col)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    order = {k: i for i, k in enumerate((*KINDS, "novel"))}
    for batch in batches:
        counts, digests, texts, novel_counts = {k: [] for k in KINDS}, [], [], []
        for base, novel in zip(batch.column("base").to_pylist(), batch.column("novel").to_pylist(), strict=True):
            for k in KINDS:
                counts[k].append(sum(x["kind"] == k for x in base))
            digests.append(hashlib.sha256(",".join(f"{x['kind']}:{x['s']}:{x['e']}" for x in base).encode()).hexdigest())
            texts.append(",".join(f"{x['kind']}:{x['s']}:{x['e']}" for x in sorted(base + novel, key=lambda x: (x["s"], order[x["kind"]]))))
            novel_counts.append(len(novel))
        columns = [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests), pa.array(texts, pa.string()), pa.array(novel_counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """find_secrets over all rows and whole texts of documents, as counts and digests."""
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    return found.mapInArrow(_digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")
