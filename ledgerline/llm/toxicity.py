"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other texts of the training rows
are unlabelled, as some of them are toxic too. With the class prior p, the
risk of a scorer is p * loss(positives as 1) + max(0, loss(unlabelled as 0) -
p * loss(positives as 0)): the second part estimates the risk on clean texts,
and where it would fall below zero (the scorer has started to fit single
texts), a step goes the other way. A few classifiers, each with all positives
and its own share of the unlabelled texts, are trained in numpy by one task
each; a text's score is the logistic of their mean. The sample that they learn
from is chosen by hashes of texts, so only its own texts are ever moved.

Features of a text are its words and the first bytes of its words (for
compounds), as square roots of their shares of the words, so that short and
long texts have vectors of equal length. Each classifier keeps those that positives
have clearly more often than unlabelled texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import in_fold, small_side, text_pieces

THRESHOLD = 0.7
CLASSIFIERS = 4
#: Bounds of the training sample: positives in all, unlabelled texts in all.
MAX_POSITIVES = 4096
MAX_UNLABELLED = 16384
SAMPLE_PARTS = 64  # tasks that read the sample
PREFIXES = (4, 5)
FEATURES = 512  # kept by a classifier, at most
LEAST_POSITIVES = 3  # texts with a feature
LEAST_APART = 3.0  # standard errors by which a feature's share of the positives is the larger
STEPS = 1000
CACHE = 100_000  # words of at most CACHED bytes whose features a task remembers
CACHED = 64


def word_features(word: bytes) -> list[bytes]:
    """The word (lower-cased, without ASCII marks at its ends), and its first bytes."""
    word = word.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    return [word + b" ", *(word[:n] for n in PREFIXES if len(word) > n)] if word else []


def features(text: str) -> dict[bytes, float]:
    words = text.lower().encode().split()
    found: Counter[bytes] = Counter()
    for word, n in Counter(words).items():
        for f in word_features(word):
            found[f] += n
    return {f: (n / len(words)) ** 0.5 for f, n in found.items()}


def nnpu_fit(x: np.ndarray, positive: np.ndarray, prior: float, steps: int = STEPS, decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear scorer, by Adam on the whole sample with the logistic loss."""
    n = x.shape[1]
    w = np.zeros(n + 1)
    w[n] = np.log(prior / (1 - prior))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    xp, xu = x[positive], x[~positive]
    for step in range(1, steps + 1):
        zp, zu = xp @ w.astype(x.dtype), xu @ w.astype(x.dtype)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        grad_clean = xu.T @ su / len(xu) - prior * (xp.T @ sp) / len(xp)
        grad = prior * (xp.T @ (sp - 1)) / len(xp) + grad_clean if clean >= 0 else -grad_clean
        grad[:n] += decay * w[:n]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:n], float(w[n])


def sample(hashes: DataFrame, most: int) -> DataFrame:
    """Distinct hashes of texts: all if they are at most ``most``, else about
    that many, by their own value. Copies of a text, under one id or many, make
    the sample neither larger nor smaller."""
    hashes = hashes.select("hash").distinct()
    share = min(1.0, most / max(1, hashes.count()))
    return hashes if share >= 1 else hashes.where(F.pmod("hash", F.lit(1 << 30)) < int(share * (1 << 30)))


def sampled_texts(docs: DataFrame, toxic_ids: DataFrame, most_positives: int, most_unlabelled: int) -> DataFrame:
    """hash, text, positive, part of the bounded training sample, a row for each
    classifier that takes it. Texts are chosen by their hashes; only those
    chosen are read as texts, where they lie. Positives are also among the
    unlabelled texts, for the prior is that of all texts."""
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("hash"))
    rows = materialize(texts.select("doc_id", "hash"), "toxicity-hashes")
    toxic = materialize(rows.join(toxic_ids, "doc_id", "left_semi").select("hash").distinct(), "toxicity-toxic")
    chosen = sample(toxic, most_positives).withColumn("positive", F.lit(True)) \
        .unionByName(sample(rows, most_unlabelled).withColumn("positive", F.lit(False))) \
        .groupBy("hash").agg(F.array_sort(F.collect_set("positive")).alias("kinds"))
    texts = texts.join(small_side(chosen, "toxicity-chosen"), "hash").groupBy("hash").agg(F.min("text").alias("text"), F.min("kinds").alias("kinds"))
    n = F.lit(CLASSIFIERS)
    parts = F.flatten(F.transform("kinds", lambda positive: F.transform(
        F.when(positive, F.sequence(F.lit(0), n - 1)).otherwise(F.array(F.pmod("hash", n).cast("int"))),
        lambda part: F.struct(positive.alias("positive"), part.alias("part")))))
    return materialize(texts.select("hash", "text", parts.alias("uses")).repartition(SAMPLE_PARTS, "hash"), "toxicity-sample")


def chosen_features(texts: DataFrame) -> dict[int, list[bytes]]:
    """The features of each classifier: those that positives have clearly more
    often than its unlabelled texts, FEATURES at most. Texts with a feature are
    counted by (part, feature) in tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_pieces(batch):
                found: Counter[tuple[int, bytes]] = Counter()
                for text, uses in zip(rows.column("text").to_pylist(), rows.column("uses").to_pylist(), strict=True):
                    own = features(text)
                    for part in {-1 if u["positive"] else u["part"] for u in uses}:
                        found.update((part, f) for f in (b"", *own))  # the empty feature counts texts
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.binary()),
                                                  pa.array(list(found.values()), pa.int64())], ["part", "feature", "n"])

    counts = materialize(texts.mapInArrow(count, "part int, feature binary, n bigint").groupBy("part", "feature").agg(F.sum("n").alias("n")), "toxicity-features")
    in_p = counts.where((F.col("part") == -1) & (F.col("n") >= LEAST_POSITIVES)).select("feature", F.col("n").alias("in_p"))
    in_u = counts.where("part >= 0").select("part", "feature", F.col("n").alias("in_u"))
    sizes = {r.part: r.n for r in counts.where(F.octet_length("feature") == 0).collect()}
    parts = sorted(p for p in sizes if p >= 0 and -1 in sizes)
    if not parts:
        return {}
    n_p = F.lit(sizes[-1])
    n_u = F.element_at(F.create_map(*(F.lit(x) for p in parts for x in (p, sizes[p]))), F.col("part"))
    mean = (F.col("in_p") + F.col("in_u") + 1) / (n_p + n_u + 2)
    apart = (F.col("in_p") / n_p - F.col("in_u") / n_u) / F.sqrt(mean * (1 - mean) * (1 / n_p + 1 / n_u))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("apart"), "feature"))
    best = in_p.where(F.octet_length("feature") > 0).withColumn("part", F.explode(F.array(*map(F.lit, parts)))) \
        .join(in_u, ["part", "feature"], "left").fillna(0, ["in_u"]).withColumn("apart", apart) \
        .where(F.col("apart") >= LEAST_APART).withColumn("rank", rank).where(F.col("rank") <= FEATURES)
    out: dict[int, list[bytes]] = {p: [] for p in parts}
    for r in best.select("part", "feature").collect():
        out[r.part].append(bytes(r.feature))
    return {p: sorted(fs) for p, fs in out.items()}


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None, most_positives: int = MAX_POSITIVES,
          most_unlabelled: int = MAX_UNLABELLED, steps: int = STEPS) -> list[tuple[dict[bytes, float], float]]:
    """The classifiers, from ``docs`` (doc_id, text) and ``labels`` (doc_id,
    toxic) of the training rows; none if no text is known as toxic. The sample
    is bounded by ``most_positives`` and ``most_unlabelled`` distinct texts.
    Without a prior, the toxic share of the labelled rows is taken. What goes to
    the fitting tasks is numbers of a classifier's own features, not texts."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()) \
        .groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    known = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("toxic").cast("int")), F.lit(0))).first()
    if not known[1]:
        return []
    if prior is None:
        prior = min(0.5, known[1] / known[0])
    texts = sampled_texts(docs, marks.where("toxic").select("doc_id"), most_positives, most_unlabelled)
    names = chosen_features(texts)
    sent = docs.sparkSession.sparkContext.broadcast(names)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {p: {f: i for i, f in enumerate(fs)} for p, fs in sent.value.items()}
        for batch in batches:
            for rows in text_pieces(batch):
                cols: list[list] = [[] for _ in range(5)]
                for key, text, uses in zip(*(rows.column(c).to_pylist() for c in ("hash", "text", "uses")), strict=True):
                    own = features(text)
                    for use in uses:
                        at = places.get(use["part"], {})
                        held = sorted((at[f], v) for f, v in own.items() if f in at)
                        for c, v in zip(cols, (use["part"], key, use["positive"], [i for i, _ in held], [v for _, v in held]), strict=True):
                            c.append(v)
                kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["part", "hash", "positive", "at", "share"])

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        own = sent.value.get(int(part["part"].iloc[0]), [])
        positive = part["positive"].to_numpy(bool)
        if not positive.any() or positive.all():
            return pd.DataFrame({"part": [], "feature": [], "weight": []})
        order = np.lexsort((positive, part["hash"].to_numpy()))
        x = np.zeros((len(part), len(own)), np.float32)
        for row, i in zip(x, order, strict=True):
            row[part["at"].iat[i]] = part["share"].iat[i]
        w, bias = nnpu_fit(x, positive[order], prior, steps)
        return pd.DataFrame({"part": part["part"].iloc[0], "feature": [b"", *own], "weight": [bias, *w]})

    found = texts.mapInArrow(vectors, "part int, hash bigint, positive boolean, at array<int>, share array<float>") \
        .groupBy("part").applyInPandas(fit, "part int, feature binary, weight double").toPandas()
    out = []
    for _, part in found.sort_values(["part", "feature"]).groupby("part"):
        weights = {bytes(f): w for f, w in zip(part["feature"], part["weight"], strict=True)}
        out.append((weights, weights.pop(b"")))
    return out


def score(docs: DataFrame, models: list[tuple[dict[bytes, float], float]], id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """id, kept columns, score of every whole text. Null and empty texts get
    the score of no words; without a model every score is 0. Repeated rows have
    a score each; columns not named are not read."""
    sent = docs.sparkSession.sparkContext.broadcast(models)
    named = [id_col, *keep]
    read = named if text_col in named else [*named, text_col]
    rows = docs.select(*(F.col(c).cast("string").alias(c) if c == text_col else F.col(c) for c in read))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        at = {f: i for i, f in enumerate(sorted(set().union(*(w for w, _ in known)))) } if known else {}
        matrix = np.array([[w.get(f, 0.0) for f in at] for w, _ in known])
        bias = np.array([b for _, b in known])
        cache: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            for part in text_pieces(batch, text_col):
                out = np.zeros(part.num_rows)
                for i, text in enumerate(part.column(text_col)) if known else ():
                    words = (text.as_py() or "").lower().encode().split()
                    total: dict[int, int] = {}
                    for word in words:
                        own = cache.get(word)
                        if own is None:
                            own = tuple(at[f] for f in word_features(word) if f in at)
                            if len(word) <= CACHED:
                                if len(cache) >= CACHE:
                                    cache.clear()
                                cache[word] = own
                        for f in own:
                            total[f] = total.get(f, 0) + 1
                    z = bias
                    if total:
                        z = bias + matrix[:, list(total)] @ np.sqrt(np.array(list(total.values())) / len(words))
                    out[i] = 1 / (1 + np.exp(-np.clip(z.mean(), -500, 500)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in named), pa.array(out)], [*named, "score"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.select(*named).schema)
    return rows.mapInArrow(run, schema + "score double")


def predict_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Train on labels outside the held-out fold, score all documents:
    doc_id, held_out, score, predicted (score >= THRESHOLD)."""
    rows = docs.select("doc_id", "text", in_fold("doc_id", folds, held).alias("held_out"))
    models = train(rows.where(~F.col("held_out")), labels.where(~in_fold("doc_id", folds, held)))
    return score(rows, models, keep=("held_out",)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
