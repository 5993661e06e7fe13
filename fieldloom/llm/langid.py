"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text becomes its letters, lower-cased, with every run of other characters as
one blank.  Its n-grams are hashed into a fixed number of buckets.  The model is
a matrix of log probabilities, buckets by languages, of a size fixed by two
parameters; it is sent to all tasks, which score slices of many texts at once:
the sparse counts of a slice times the matrix.
"""

from __future__ import annotations

import sys
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import crc_mod, pieces, table

#: Buckets of the n-gram hash, longest n-gram, added to each count.
BUCKETS, ORDER, SMOOTHING = 1 << 15, 3, 0.5
#: Most languages of a model: with BUCKETS it bounds the matrix (32,768 x 400 x 4 bytes = 52 MB).
MAX_LANGUAGES = 400
#: About so many labelled texts per language are learned from, chosen by a hash of the id. All are where there are fewer.
TRAIN_ROWS = 4_000
#: A text below this posterior probability is rejected by the pipeline stage.
REJECT_BELOW = 0.5
#: Texts of one slice, in bytes.
SLICE = 1 << 20


@cache
def _letters() -> np.ndarray:
    """For each code point itself if it is a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(sys.maxunicode + 1)], np.uint32)


def gram_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text) of all n-grams of order 1 to ORDER of the texts, and which texts have letters."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer(" ".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in lowered])[:-1]
    chars = _letters()[points]
    blank = chars == 32
    keep = ~(blank & np.concatenate([[True], blank[:-1]]))
    chars, owner, blank = chars[keep], owner[keep], blank[keep]
    lettered = np.zeros(len(texts), bool)
    lettered[owner[~blank]] = True
    buckets, owners = [], []
    code = np.zeros(len(chars), np.uint32)
    for order in range(1, ORDER + 1):
        # wrapping arithmetic modulo 2**32; an n-gram starts and ends within one text
        n = len(chars) - order + 1
        if n <= 0:
            break
        code = (code[:n] if order == 1 else code[:n] * np.uint32(0x01000193)) + chars[order - 1:] * np.uint32(0x9E3779B1) + np.uint32(order)
        mixed = code ^ (code >> np.uint32(15))
        mixed *= np.uint32(0x85EBCA6B)
        whole = (owner[:n] == owner[order - 1:]) & ~(blank[:n] if order == 1 else np.zeros(n, bool))
        buckets.append((mixed >> np.uint32(17))[whole])
        owners.append(owner[:n][whole])
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32), lettered
    return np.concatenate(buckets), np.concatenate(owners), lettered


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray, texts: np.ndarray):
        """``counts``: n-grams by language and bucket; ``texts``: learned texts by language."""
        self.languages = languages
        totals = counts.sum(axis=1, keepdims=True)
        self.matrix = np.ascontiguousarray(np.log((counts + SMOOTHING) / (totals + SMOOTHING * BUCKETS)).T.astype(np.float32))
        self.prior = np.log(texts / max(1, texts.sum()))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        buckets, owners, lettered = gram_buckets(texts)
        scores = np.tile(self.prior, (len(texts), 1)) if self.languages else np.zeros((len(texts), 1))
        for k in range(len(self.languages)):
            scores[:, k] += np.bincount(owners, weights=self.matrix[:, k][buckets], minlength=len(texts))
        best = scores.argmax(axis=1)
        chance = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
        known = lettered & bool(self.languages)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, known, strict=True)], np.where(known, chance, 0.0)


def _count_batches(batches):
    counts: dict[str, np.ndarray] = {}
    for part in pieces(batches, "text", SLICE):
        langs = np.array(part.column("lang").to_pylist(), object)
        texts = part.column("text").to_pylist()
        for lang in set(langs):
            mine = [t for t, name in zip(texts, langs, strict=True) if name == lang]
            row = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            row[:BUCKETS] += np.bincount(gram_buckets(mine)[0], minlength=BUCKETS)
            row[BUCKETS] += len(mine)
    for lang, row in counts.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(row[at])], names=["lang", "bucket", "n"])


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of (doc_id, text, lang) rows; null texts and labels are left out.

    About ``rows`` texts of each language are used: those whose hashed id is
    below a threshold that follows from the language's number of texts.
    """
    known = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    if not sizes:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0))
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, rows / n)))])
    chosen = known.where(F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit("train")), 1 << 20) < share[F.col("lang")] * (1 << 20))
    counted = chosen.select("text", "lang").mapInArrow(_count_batches, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toPandas()                     # at most languages x buckets rows
    languages = sorted(sizes)
    counts = np.zeros((len(languages), BUCKETS + 1))
    counts[np.searchsorted(languages, got["lang"].to_numpy(str)) if len(got) else [], got["bucket"].to_numpy(int)] = got["n"].to_numpy()
    return Model(languages, counts[:, :BUCKETS], np.array([float(sizes[x]) for x in languages]))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text. Null, empty and letterless texts: ``und`` with score 0."""
    def run(batches):
        for part in pieces(batches, "text", SLICE):
            langs, scores = model.predict(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def learned(docs: DataFrame) -> Model:
    return train(docs.where(crc_mod("doc_id", 5) != 0))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learned(docs)).select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def keep_known(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without letters, or whose language stays unclear, go."""
    model = learned(docs)

    def run(batches):
        for whole in batches:
            for part in pieces([whole], "text", SLICE):
                langs, scores = model.predict(part.column("text").to_pylist())
                yield part.filter(pa.array([x != "und" and s >= REJECT_BELOW for x, s in zip(langs, scores, strict=True)]))

    return docs.mapInArrow(run, docs.schema)


QUERIES = {"op2_language_id": op2_language_id}
