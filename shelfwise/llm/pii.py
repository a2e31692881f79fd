"""PII by information-theoretic sanitisation.

Formats find the protected entities.  How much a term of the documents that
hold an entity reveals about it is estimated from the corpus: its pointwise
mutual information with the entity, as a share of the entity's information
content.  Terms above the disclosure threshold become spans as well, wherever
they stand in a text that holds the entity, and are generalised with it.
Frequencies count whole documents, and all of them.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import bounded_broadcast, stage

KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match starts where a run of digits starts: inside a run it would have started earlier.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Letters and digits, two or more.
_TERM = re.compile(r"[^\W_]{2,}")


def _emails(text: str):
    """Leftmost non-overlapping addresses, found from their @ signs (linear in the text)."""
    edge, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > edge and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            edge = domain.end()
        at = text.find("@", max(at + 1, edge))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    if not text:
        return []
    out = [("email", *s) for s in _emails(text)] if "@" in text else []
    out += [("ip", *s) for s in _ips(text)]
    out += [("card", *s) for s in _cards(text)]
    return out + ([("phone", *s) for s in _phones(text)] if "+" in text else [])


def _number(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def entity_of(kind: str, text: str) -> int:
    return _number(kind, re.sub(r"[^0-9a-z@.+]", "", text.lower()))


def terms_of(text: str) -> set[str]:
    """The distinct terms of a whole text, in small letters."""
    return {w.lower() for w in set(_TERM.findall(text))}


def term_spans(text: str, wanted: set[int]) -> list[tuple[int, int]]:
    """(start, end) of every occurrence of the wanted terms that overlaps no base span."""
    taken = sorted((a, b) for _, a, b in base_spans(text))
    out, k, edge, number = [], 0, 0, {}
    for m in _TERM.finditer(text):
        if (n := number.get(m[0])) is None:
            n = number[m[0]] = _number(m[0].lower())
        if n not in wanted:
            continue
        while k < len(taken) and taken[k][0] < m.end():      # edge: where the base spans before the term's end reach
            edge, k = max(edge, taken[k][1]), k + 1
        if edge <= m.start():
            out.append(m.span())
    return out


def join_spans(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, tid (identity of the text), counts by kind, base span string,
    its distinct entities and, where there are any, the distinct terms of the
    whole text."""
    names = ["doc_id", "tid", *(f"n_{k}" for k in KINDS), "base", "entities", "terms"]
    longs = pa.list_(pa.int64())

    def run(batches):
        for batch in batches:
            rows = []
            for r in range(batch.num_rows):
                text = batch.column(2)[r].as_py() or ""
                spans = base_spans(text)
                count = Counter(k for k, _, _ in spans)
                rows.append((*(count[k] for k in KINDS), join_spans(spans),
                             list({entity_of(k, text[a:b]) for k, a, b in spans}),
                             [_number(w) for w in terms_of(text)] if spans else []))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 pa.array(columns[4], pa.string()), *(pa.array(c, longs) for c in columns[5:])], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col), text_id(text_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {kind}, tid string, {', '.join(f'n_{k} long' for k in KINDS)}, base string, "
             "entities array<long>, terms array<long>"))


def text_id(text_col: str = "text"):
    return F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("tid")


def term_counts(docs: DataFrame, text_col: str = "text", held: int = 300_000) -> DataFrame:
    """(t, n): in how many documents each term stands, in parts to be summed; a
    task holds at most ``held`` terms and those of one document."""

    def out(count):
        return pa.RecordBatch.from_arrays(
            [pa.array([_number(w) for w in count], pa.int64()), pa.array(list(count.values()), pa.int64())], ["t", "n"])

    def run(batches):
        count: Counter = Counter()
        for batch in batches:
            for r in range(batch.num_rows):
                count.update(terms_of(batch.column(0)[r].as_py() or ""))
                if len(count) > held:
                    yield out(count)
                    count.clear()
        if count:
            yield out(count)

    return docs.select(text_col).mapInArrow(run, "t long, n long")


def disclosing(found: DataFrame, docs: DataFrame, threshold: float, support: int) -> DataFrame:
    """(tid, t): the terms to generalise in each text, as they reveal one of its entities.

    disclosure = PMI(t; e) / IC(e) with document frequencies over whole texts;
    ``support`` different texts must hold both, so that one text's chance
    company (and its copies) reveals nothing.  As n_et <= n_e, the disclosure
    stays below the threshold where n_t > n_e^threshold * n^(1 - threshold):
    such terms are left out before pairs are formed.
    """
    n = float(max(2, found.count()))
    held = found.where(F.size("entities") > 0)
    texts = held.groupBy("tid").agg(F.count("*").alias("copies"), F.first("entities").alias("entities"))
    entities = stage(texts.select("copies", F.explode("entities").alias("e")).groupBy("e").agg(
        F.count("*").alias("texts"), F.sum("copies").alias("n_e")).where(
        (F.col("texts") >= support) & (F.col("n_e") < n)).withColumn(
        "most", F.pow("n_e", F.lit(threshold)) * F.pow(F.lit(n), F.lit(1 - threshold)) * (1 + 1e-9)), "pii-entities")
    # the texts that hold such an entity, numbered; their entities
    members = (texts.select("tid", "copies", F.explode("entities").alias("e"))
               .join(bounded_broadcast(entities), "e").select("tid", "copies", "e", "n_e", "most"))
    numbered = stage(members.groupBy("tid").agg(F.first("copies").alias("copies"), F.max("most").alias("most"))
                     .withColumn("text", F.monotonically_increasing_id()), "pii-texts")
    members = stage(members.select("tid", "e", "n_e", F.col("most").alias("own"))
                    .join(numbered.select("tid", "text", "copies"), "tid").drop("tid"), "pii-members")
    top = entities.agg(F.max("most")).first()[0] or 0.0
    counts = stage(term_counts(docs).groupBy("t").agg(F.sum("n").alias("n_t")), "pii-terms")
    # terms above every entity's bound are few and stand in most texts: out before anything is dealt by term
    common = counts.where(F.col("n_t") > top).select("t")
    kept = stage(held.select("tid", "terms").join(bounded_broadcast(numbered), "tid").groupBy("tid").agg(
        F.first("text").alias("text"), F.first("most").alias("most"), F.first("terms").alias("terms"))
        .select("text", "most", F.explode("terms").alias("t"))
        .join(bounded_broadcast(common), "t", "left_anti"), "pii-kept")
    rare = kept.join(counts, "t").where(F.col("n_t") <= F.col("most")).select("text", "t", "n_t")
    pairs = stage(rare.join(members, "text").where(F.col("n_t") <= F.col("own"))
                  .select("text", "copies", "e", "n_e", "t", "n_t"), "pii-pairs")
    together = pairs.groupBy("e", "t", "n_e", "n_t").agg(F.count("*").alias("texts"), F.sum("copies").alias("n_et"))
    ic, pmi = -F.log(F.col("n_e") / n), F.log(F.col("n_et") * n / (F.col("n_e") * F.col("n_t")))
    marks = together.where((F.col("texts") >= support) & (pmi / ic >= threshold)).select("e", "t")
    return (pairs.select("text", "e", "t").join(marks, ["e", "t"]).select("text", "t").distinct()
            .join(numbered.select("tid", "text"), "text").select("tid", "t"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.9,
             support: int = 3) -> DataFrame:
    """Per row: doc_id, tid, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    ``spans`` holds the base spans by kind, then every occurrence of the
    disclosing terms ("term:start:end") in the texts that hold the entities they
    reveal, but for those inside base spans.  Null and empty texts have none;
    repeated rows repeat; other columns are ignored.
    """
    found = stage(detect(docs, id_col, text_col), "pii-found")
    marks = stage(disclosing(found, docs.select(F.col(text_col).alias("text")), threshold, support)
                  .groupBy("tid").agg(F.collect_set("t").alias("wanted")), "pii-marks")

    def run(batches):
        for batch in batches:
            spans = [",".join(f"term:{a}:{b}" for a, b in term_spans(text, set(wanted))) for text, wanted in
                     zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.string())], ["tid", "more"])

    # of each marked text one copy; the others never leave their scan
    marked = (docs.select(text_id(text_col), F.col(text_col).alias("text"))
              .join(bounded_broadcast(marks, marks.select("tid")), "tid", "left_semi")
              .groupBy("tid").agg(F.first("text").alias("text")))
    terms = marked.join(marks, "tid").select("tid", "text", "wanted").mapInArrow(run, "tid string, more string")
    parts = [F.when(F.col(c) != "", F.col(c)) for c in ("base", "more")]
    return (found.drop("entities", "terms").join(terms, "tid", "left")
            .select("doc_id", "tid", *(f"n_{k}" for k in KINDS), F.sha2(F.col("base"), 256).alias("base_sha256"),
                    F.concat_ws(",", *parts).alias("spans")))


# What an entity is generalised to.
GENERAL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}


def sanitise_text(text: str, spans: str) -> str:
    """The text with its spans generalised; of overlapping spans the first, then the longer one counts."""
    parts = [s.split(":") for s in spans.split(",")] if spans else []
    out, edge = [], 0
    for a, b, kind in sorted((int(a), -int(b), k) for k, a, b in parts):
        if a >= edge:
            out += [text[edge:a], GENERAL[kind]]
            edge = -b
        elif -b > edge:
            edge = -b                                # the tail of an overlapping span goes too
    return "".join([*out, text[edge:]])


@F.pandas_udf(T.StringType())
def _clean(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else sanitise_text(t, s) for t, s in zip(texts, spans, strict=True)],
                     dtype=object)


def sanitise(docs: DataFrame, spans: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the spans of ``spans`` (tid, spans) generalised in the text;
    rows without spans are unchanged.  Only texts with spans go through Python."""
    marked = spans.where(F.col("spans") != "").groupBy("tid").agg(F.min("spans").alias("__spans"))
    joined = (docs.withColumn("__tid", text_id(text_col))
              .join(marked.withColumnRenamed("tid", "__tid"), "__tid", "left"))
    only_marked = F.when(F.col("__spans").isNotNull(), F.col(text_col))
    new = F.coalesce(_clean(only_marked, F.col("__spans")), F.col(text_col))
    return joined.withColumn(text_col, new).select(*docs.columns)

