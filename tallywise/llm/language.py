"""Language identification by multilingual mixture inference.

A language is a distribution over hashed byte n-grams, learned from labelled documents. A document
is a mixture of languages: expectation-maximisation finds the proportions that make its n-grams
most likely. Languages join the set one at a time, while the gain in log-likelihood exceeds a
penalty that grows with the logarithm of the document's length.

Edge cases: a null or empty text, or one without any letter, is `und` with score 0, as is every
text when no labelled row exists. Ties take the language that sorts first. Labelled rows with null
text or language teach nothing; rows that repeat a doc_id count each. Whole texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import values

UNKNOWN = "und"
BUCKETS = 1 << 15
#: Bound of the fit: labelled documents per language, drawn by a hash of their id.
FIT_ROWS_PER_LANGUAGE = 4_000
SMOOTHING = 0.5
#: Log-likelihood that a further language must add, in units of the logarithm of the n-gram count.
PENALTY = 4.0
EM_STEPS = 25
#: ASCII bytes: capitals to small letters, all that is no letter to a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class LanguageModel:
    """`log_prob[g, l]`: log-likelihood of bucket g in language l; languages are sorted by name."""

    languages: tuple[str, ...]
    log_prob: np.ndarray


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the hashed 2-, 3- and 4-byte n-grams of the letters, words apart by a space."""
    words = text.lower().encode("utf-8", "ignore").translate(LETTERS).split()
    data = np.frombuffer(b" %b " % b" ".join(words), np.uint8).astype(np.uint32)
    two = data[:-1] * np.uint32(257) + data[1:]
    three = two[:-1] * np.uint32(263) + data[2:]
    four = three[:-1] * np.uint32(269) + data[3:]
    counts = np.zeros(BUCKETS, np.int64)
    for order, grams in enumerate((two, three, four)):
        mixed = (grams + np.uint32(order)) * np.uint32(2654435761)
        counts += np.bincount(mixed >> np.uint32(17), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _likelihood(counts, prob, share) -> float:
    return float(counts @ np.log(prob @ share))


def _mix(counts, prob, share) -> np.ndarray:
    """Proportions of the given languages by expectation-maximisation."""
    total = counts.sum()
    for _ in range(EM_STEPS):
        parts = prob * share
        step = (counts / parts.sum(axis=1)) @ parts / total
        if np.abs(step - share).max() < 1e-3:
            return step
        share = step
    return share


def infer(model: LanguageModel, text: str | None) -> list[tuple[str, float]]:
    """(language, proportion) of the chosen set, largest first; empty if undetermined."""
    if not model.languages or not has_letter(text):
        return []
    grams, counts = ngram_counts(text)
    if not len(grams):
        return []
    counts = counts.astype(np.float64)
    log_prob = model.log_prob[grams]
    alone = counts @ log_prob
    # Scaled by the best language of each n-gram, so that no likelihood vanishes.
    prob = np.exp(log_prob - log_prob.max(axis=1, keepdims=True))
    chosen, share = [int(alone.argmax())], np.ones(1)
    price, total = PENALTY * np.log(counts.sum() + 1), counts.sum()
    now = _likelihood(counts, prob[:, chosen], share)
    while len(chosen) < len(model.languages):
        # Only a language whose likelihood rises at proportion zero can raise it anywhere.
        slope = (counts / (prob[:, chosen] @ share)) @ prob / total
        options = [l for l in np.argsort(-slope, kind="stable") if l not in chosen and slope[l] > 1]
        best = None
        for l in options:
            tried = [*chosen, int(l)]
            mixed = _mix(counts, prob[:, tried], np.append(share * 0.8, 0.2))
            gain = _likelihood(counts, prob[:, tried], mixed) - now
            if gain > price and (best is None or gain > best[0]):
                best = (gain, tried, mixed)
        if best is None:
            break
        now, chosen, share = now + best[0], best[1], best[2]
    ranked = sorted(zip(share, chosen), key=lambda x: (-x[0], x[1]))
    return [(model.languages[l], float(s)) for s, l in ranked]


def fit(labelled: DataFrame, rows_per_language: int = FIT_ROWS_PER_LANGUAGE) -> LanguageModel:
    """Learn from rows (doc_id, text, lang); at most about `rows_per_language` of each language.

    Counts are added up on Spark; the driver receives one array of BUCKETS numbers per language.
    """
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"))
    kept = usable.join(F.broadcast(sizes), "lang").where(
        F.pmod(F.xxhash64("doc_id", F.lit("language fit")), F.lit(1 << 20)) * F.col("n")
        < F.lit(rows_per_language << 20))
    rows = (kept.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).groupBy("lang")
            .agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).orderBy("lang").collect())
    if not rows:
        return LanguageModel((), np.zeros((BUCKETS, 0)))
    counts = np.full((BUCKETS, len(rows)), SMOOTHING)
    for l, row in enumerate(rows):
        at, n = np.array(row.counts, dtype=np.int64).T
        counts[at, l] += n
    return LanguageModel(tuple(r.lang for r in rows), np.log(counts / counts.sum(axis=0)))


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(values(batch.column(0)), values(batch.column(1))):
            if has_letter(text):
                grams, n = ngram_counts(text)
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[grams] += n
    for lang, counts in sums.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
            ["lang", "bucket", "n"])


def with_language(docs: DataFrame, model: LanguageModel, out: str = "language") -> DataFrame:
    """`docs` with `out`, in place of a column of that name: a struct of lang_pred, score (its proportion) and langs (the set)."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.log_prob))  # BUCKETS numbers per language

    def predict(texts: pa.Array) -> pa.Array:
        known = LanguageModel(*shared.value)
        found = [infer(known, t) for t in values(texts)]
        return pa.StructArray.from_arrays(
            [pa.array([f[0][0] if f else UNKNOWN for f in found], pa.string()),
             pa.array([min(1.0, f[0][1]) if f else 0.0 for f in found], pa.float64()),
             pa.array([[lang for lang, _ in f] for f in found], pa.list_(pa.string()))],
            ["lang_pred", "score", "langs"])

    # Not deterministic for the optimizer, which else repeats the inference for a filter on it.
    predicted = F.arrow_udf(predict, "struct<lang_pred:string,score:double,langs:array<string>>")
    return docs.withColumn(out, predicted.asNondeterministic()("text"))
