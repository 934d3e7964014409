"""Language identification: sparse multinomial regression on character n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import small_batches

UNKNOWN = "und"
#: Characters whose n-grams are held at once.
STRETCH = 1 << 19
SPACE = 32
TEMPERATURES = np.geomspace(0.02, 5.0, 60)


@dataclass(frozen=True)
class Settings:
    """Of the features, the sample that is fitted on, and the learner.

    ``train_rows`` and ``calibration_rows`` bound the labelled rows that weights and temperature are fitted on (their expected
    number: every row is drawn by a hash of its id, at a rate that gives each language the same share). Document frequencies
    come from all labelled rows. The sample is fitted in as many shards as have ``shard_rows`` rows each, ``shards`` at most; a shard is passed over
    until its mean loss falls by less than ``still`` of itself, ``passes`` times at most.
    """

    buckets: int = 1 << 16
    longest: int = 3
    train_rows: int = 4000
    calibration_rows: int = 2000
    shards: int = 4
    shard_rows: int = 500
    passes: int = 40
    still: float = 0.02
    alpha: float = 1.0
    beta: float = 0.1
    l1: float = 0.002
    l2: float = 0.01
    max_labels: int = 200


@dataclass(frozen=True)
class Model:
    settings: Settings
    labels: tuple[str, ...]
    idf: np.ndarray  # per bucket
    weights: np.ndarray  # per bucket and label, the last row is the constant
    temperature: float


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    """Lower-case letter of each of the first 65,536 code points, a space for what is no letter."""
    out = np.full(1 << 16, SPACE, np.uint32)
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def letters(text: str) -> np.ndarray:
    """Code points of the text in lower case, everything but letters as a space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _lower()[np.minimum(codes, 0xFFFF)]
    for code in np.unique(codes[codes > 0xFFFF]).tolist():
        out[codes == code] = ord(chr(code).lower()) if chr(code).isalpha() else SPACE
    return out


def _blocks(texts: list[str], longest: int):
    """(text numbers, code points, whether carried over) of about a stretch each; long texts go in several, which overlap."""
    numbers, codes, carried, size = [], [], [], 0
    for i, text in enumerate(texts):
        for start in range(0, len(text), STRETCH):
            back = min(start, longest - 1)
            part = letters(text[start - back: start + STRETCH])
            numbers.append(np.full(len(part), i, np.int32))
            codes.append(part)
            old = np.zeros(len(part), bool)
            old[:back] = True
            carried.append(old)
            size += len(part)
            if size >= STRETCH:
                yield np.concatenate(numbers), np.concatenate(codes), np.concatenate(carried)
                numbers, codes, carried, size = [], [], [], 0
    if size:
        yield np.concatenate(numbers), np.concatenate(codes), np.concatenate(carried)


def grams(texts: list[str], settings: Settings):
    """Arrays (text number, bucket) of the n-grams of whole texts.

    N-grams of 1 to ``longest`` characters without two spaces in a row and not a lone space; buckets by multiplicative hashing.
    """
    shift = np.uint32(32 - settings.buckets.bit_length() + 1)
    for numbers, codes, carried in _blocks(texts, settings.longest):
        blank = codes == SPACE
        value, good = np.zeros(len(codes), np.uint32), np.ones(len(codes), bool)
        for n in range(1, settings.longest + 1):
            if len(codes) < n:
                break
            end = n - 1
            m = len(codes) - end
            value = value[:m] * np.uint32(0x01000193) + codes[end:]
            good = good[:m]
            if n > 1:
                good = good & ~(blank[end - 1: end - 1 + m] & blank[end:]) & (numbers[:m] == numbers[end:])
            use = good & ~carried[end:]
            if n == 1:
                use &= ~blank
            hashed = ((value ^ np.uint32(n * 0x3779)) * np.uint32(0x9E3779B1)) >> shift
            yield numbers[:m][use], hashed[use].astype(np.int64)


def _frequencies(settings: Settings):
    def run(batches):
        counts, total = np.zeros(settings.buckets, np.int64), 0
        seen = np.zeros(settings.buckets, bool)
        for batch in batches:
            for text in batch.column(0).to_pylist():  # whole texts, one at a time
                seen[:] = False
                for _, bucket in grams([text], settings):
                    seen[bucket] = True
                counts += seen
                total += 1
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(counts[found], total))], names=["bucket", "n"]
        )

    return run


def _vector(text: str, idf: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and TF-IDF values; term frequencies are shares of the text's n-grams. The constant comes last."""
    found = [b for _, b in grams([text], settings)]
    bucket, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    return np.append(bucket, settings.buckets), np.append(n / max(1, n.sum()) * idf[bucket], 1.0)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], labels: int, settings: Settings) -> np.ndarray:
    """Weights by follow-the-regularised-leader with per-coordinate rates, L1 and L2 penalties."""
    z = np.zeros((settings.buckets + 1, labels))
    n = np.zeros_like(z)

    def solve(z, n):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - settings.l1, 0)
        return -shrunk / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2)

    before = np.inf
    for _ in range(settings.passes):
        loss = 0.0
        for bucket, x, label in rows:
            zb, nb = z[bucket], n[bucket]
            w = solve(zb, nb)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            loss -= np.log(max(p[label], 1e-300))
            p[label] -= 1
            g = x[:, None] * p
            squares = nb + g * g
            z[bucket] = zb + g - (np.sqrt(squares) - np.sqrt(nb)) / settings.alpha * w
            n[bucket] = squares
        if loss > (1 - settings.still) * before:
            break
        before = loss
    return solve(z, n)


def logits(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Logits per text and label, and the number of n-grams of each text, from whole texts."""
    table = np.ascontiguousarray((model.weights[:-1] * model.idf[:, None]).T.astype(np.float32))
    sums, total = np.zeros((len(texts), len(model.labels))), np.zeros(len(texts), np.int64)
    for number, bucket in grams(texts, model.settings):
        total += np.bincount(number, minlength=len(texts))
        for label in range(len(model.labels)):
            sums[:, label] += np.bincount(number, table[label][bucket], minlength=len(texts))
    return sums / np.maximum(total, 1)[:, None] + model.weights[-1], total


def _softmax(values: np.ndarray) -> np.ndarray:
    e = np.exp(values - values.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Label and calibrated probability of every text; ``und`` and 0 without a letter or without a model."""
    if not model.labels or not texts:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    values, total = logits([t or "" for t in texts], model)
    chance = _softmax(values / model.temperature)
    best = chance.argmax(axis=1)
    known = total > 0  # a text with a letter has an n-gram
    return [model.labels[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, chance[np.arange(len(best)), best], 0.0)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", settings: Settings = Settings()) -> Model:
    """Fit on the rows of ``labelled``; rows with a null text or label are left out.

    Document frequencies are summed over all rows in every task before the shuffle. Weights are fitted on a
    bounded sample (see :class:`Settings`), in shards whose weights are averaged; the temperature minimises the log
    loss on other rows. What reaches the driver is bounded by buckets, labels and temperatures.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")
    ).filter("text IS NOT NULL AND label IS NOT NULL")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().limit(settings.max_labels + 1).collect()}
    labels = tuple(sorted(counts))
    if len(labels) > settings.max_labels:
        raise ValueError(f"more than {settings.max_labels} labels")
    zero = np.zeros((settings.buckets + 1, len(labels)))
    if not labels:
        return Model(settings, labels, np.zeros(settings.buckets), zero, 1.0)
    found = rows.select("text").mapInArrow(_frequencies(settings), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(settings.buckets), 0
    for bucket, n in found:
        if bucket < 0:
            total = n
        else:
            df[bucket] = n
    idf = np.log((1 + total) / (1 + df)) + 1

    per_train, per_calibration = settings.train_rows / len(labels), settings.calibration_rows / len(labels)
    rate = F.create_map(*[F.lit(v) for k, c in counts.items() for v in (k, min(0.7, per_train / c))])
    upto = F.create_map(*[F.lit(v) for k, c in counts.items() for v in (k, min(0.7, per_train / c) + min(0.3, per_calibration / c))])
    number = F.create_map(*[F.lit(v) for i, k in enumerate(labels) for v in (k, i)])
    # The id takes part so that the draw does not depend on the order of rows, the text so that a repeated id does not fill the sample.
    drawn = rows.select(
        "text", number[F.col("label")].alias("label"), rate[F.col("label")].alias("rate"), upto[F.col("label")].alias("upto"),
        (F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / (1 << 30)).alias("draw"),
    ).filter("draw < upto")

    def shard(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("draw").to_numpy())
        taken = table.take(order).to_pylist()
        w = ftrl([(*_vector(r["text"], idf, settings), r["label"]) for r in taken], len(labels), settings)
        at = np.flatnonzero(w)
        return pa.table({"cell": pa.array(at, pa.int64()), "w": w.ravel()[at]})

    expected = sum(min(0.7 * c, per_train) for c in counts.values())
    shards = max(1, min(settings.shards, int(expected // settings.shard_rows)))
    sums = (
        drawn.filter("draw < rate").withColumn("shard", (F.col("draw") * (1 << 30)).cast("long") % shards)
        .groupBy("shard").applyInArrow(shard, "cell long, w double").groupBy("cell").agg((F.sum("w") / shards).alias("w")).toArrow()
    )  # only cells of weight, in two flat columns
    weights = zero.ravel()
    weights[sums.column("cell").to_numpy()] = sums.column("w").to_numpy()
    model = Model(settings, labels, idf, weights.reshape(zero.shape), 1.0)

    def losses(batches):
        loss = np.zeros(len(TEMPERATURES))
        for batch in batches:
            values, _ = logits(batch.column(0).to_pylist(), model)
            label = batch.column(1).to_numpy()
            for i, t in enumerate(TEMPERATURES):
                loss[i] -= np.log(np.maximum(_softmax(values / t)[np.arange(len(label)), label], 1e-12)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(loss)), pa.int32()), pa.array(loss)], names=["t", "loss"])

    tried = drawn.filter("draw >= rate").select("text", "label").mapInArrow(losses, "t int, loss double").groupBy("t").agg(F.sum("loss").alias("loss")).collect()
    best = min(tried, key=lambda r: (round(r["loss"], 9), r["t"]), default=None)
    temperature = float(TEMPERATURES[best["t"]]) if best is not None and best["loss"] > 0 else 1.0
    return Model(settings, labels, idf, model.weights, temperature)


def language(text: Column, model: Model) -> Column:
    """``struct<lang: string, score: double>`` of a text column."""

    @F.pandas_udf("lang string, score double")
    def found(texts: pd.Series) -> pd.DataFrame:
        lang, score = predict([t if isinstance(t, str) else None for t in texts], model)
        return pd.DataFrame({"lang": lang, "score": score})

    return found(text)


def held_out(id_column: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row belongs to the fold that is never learned from; a null id does."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == fold, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``, learned from the labelled rows that are not held out.

    Predictions look at the text alone. ``und`` with score 0 stands for a null text, one without a letter, and for every text if
    no row is labelled. Every row is answered for itself; an empty table gives an empty result; other columns are not
    read. Equal probabilities go to the label that sorts first.
    """
    model = fit(docs.filter(~held_out(F.col(id_col))), id_col, text_col, label_col, settings)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), language(F.col(text_col), model).alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", least: float = 0.4, settings: Settings = Settings()) -> DataFrame:
    """The rows whose language is known with a probability of at least ``least``; columns stay as they are."""
    model = fit(docs.filter(~held_out(F.col(id_col))), id_col, text_col, label_col, settings)
    kept = docs.select(F.struct("*").alias("row"), language(F.col(text_col), model).alias("found"))
    return kept.filter((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least)).select("row.*")
