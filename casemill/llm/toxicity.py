"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import words
from casemill.llm.shared import materialize, with_key, without

#: Documents whose crc32 of the id modulo FOLDS is HELD_OUT are never learnt from; of the others those with
#: FIT fit the last step, and the rest give the counts.
FOLDS, HELD_OUT, FIT = 4, 2, 3
#: The bound of the sample: at most so many labelled documents of each class and use. Their whole texts give counts, so that the
#: model, which the tasks hold in memory, is bounded by the different pairs of words in twice so many documents.
SAMPLE_DOCS = 1_500
#: Lengths of the stretches of words whose likeliest is looked for, besides the whole text.
STRETCHES = (1, 6, 24)
FEATURES = 3 * (1 + len(STRETCHES))
#: A document is predicted toxic from this score on.
THRESHOLD = 0.3
#: Letters of a word's stem. Words that are too rare for counts of their own back off to their stems'.
STEM = 4
EDGES = " .,;:!?\"'()[]{}|*<>-"


@dataclass
class Side:
    """Looks numbers up by hash; others get `rest`."""

    keys: np.ndarray
    values: np.ndarray
    rest: float

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.rest)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], self.rest)


@dataclass
class Model:
    """Logarithms of the ratio of both classes' probabilities: of words, of seen pairs, of backing off after a word, and of stems."""

    word: Side
    pair: Side
    back: Side
    stem: Side
    means: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spreads: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    prior: float = 0.0


def packed(model: Model) -> tuple:
    """The model as plain arrays and numbers, which workers can read without this module at hand."""
    sides = tuple((side.keys, side.values, side.rest) for side in (model.word, model.pair, model.back, model.stem))
    return sides, model.means, model.spreads, model.weights, model.prior


def unpacked(plain: tuple) -> Model:
    sides, *rest = plain
    return Model(*(Side(*side) for side in sides), *rest)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return words.mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's words begin, their hashes and their stems': lower-cased, without marks at either edge."""
    begins, codes, different = words.split(texts, lower=True)
    bare = pc.utf8_lower(pc.ascii_trim(different, characters=EDGES))
    stems = pc.utf8_slice_codeunits(bare, 0, STEM).dictionary_encode()
    return begins, words.hashes(bare)[codes], words.hashes(stems.dictionary)[stems.indices.to_numpy(zero_copy_only=False)][codes]


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Kneser-Ney discounts of counts 0, 1, 2, and 3 or more, by how many counts there are of each."""
    n = [max(1, int((counts == k).sum())) for k in range(5)]
    y = n[1] / (n[1] + 2 * n[2])
    return np.array([0.0, *(min(k, max(0.1 * k, k - (k + 1) * y * n[k + 1] / n[k])) for k in (1, 2, 3))])


def fit_sides(pairs: pa.Table) -> tuple[Side, Side, Side]:
    """Words, pairs and backing off by counted pairs: columns v, w (hashes), ordinary, toxic (counts).

    In each class a pair's discounted count is interpolated with the class's discounted continuation count of
    its second word (how many different words it follows), and that with the continuation count of both classes together.
    """
    pairs = pairs.sort_by([("v", "ascending"), ("w", "ascending")])  # sums of fractions then don't depend on the order of rows
    v, w = (pairs[c].to_numpy().view(np.uint64) for c in "vw")
    contexts, v_at = np.unique(v, return_inverse=True)
    vocabulary, w_at = np.unique(w, return_inverse=True)
    shared = (np.bincount(w_at, minlength=len(vocabulary)) + 0.5) / (len(v) + 0.5 * (len(vocabulary) + 1))
    unseen = 0.5 / (len(v) + 0.5 * (len(vocabulary) + 1))
    found = []
    for name in ("ordinary", "toxic"):
        c = pairs[name].to_numpy()
        seen = c > 0
        follows = np.bincount(w_at[seen], minlength=len(vocabulary))
        e = _discounts(follows)
        all_follows = max(1, int(follows.sum()))
        taken = e[np.minimum(follows, 3)]
        gamma = taken.sum() / all_follows if seen.any() else 1.0
        word = (follows - taken) / all_follows + gamma * shared
        d = _discounts(c)
        cut = d[np.minimum(c, 3)]
        n_v = np.bincount(v_at, c, len(contexts))
        back = np.where(n_v > 0, np.bincount(v_at, cut, len(contexts)) / np.maximum(n_v, 1), 1.0)
        pair = np.where(n_v[v_at] > 0, (c - cut) / np.maximum(n_v[v_at], 1), 0.0) + back[v_at] * word[w_at]
        found.append((word, pair, back, gamma * unseen))
    (word_o, pair_o, back_o, rest_o), (word_t, pair_t, back_t, rest_t) = found
    keys = pair_keys(v, w)
    order = np.argsort(keys)
    ratio = lambda t, o: np.log(np.maximum(t, 1e-300) / np.maximum(o, 1e-300)).astype(np.float32)
    return (Side(vocabulary, ratio(word_t, word_o), float(np.log(max(rest_t, 1e-300) / max(rest_o, 1e-300)))), Side(keys[order], ratio(pair_t, pair_o)[order], np.nan), Side(contexts, ratio(back_t, back_o), 0.0))


def fit_model(counted: DataFrame) -> Model:
    """The model of counted pairs of words, and of their stems (rows whose column stem is true). The driver holds the pairs of one kind at a time."""
    of = lambda stem: counted.filter(F.col("stem") == stem).select("v", "w", "ordinary", "toxic").toArrow()
    sides = fit_sides(of(False))
    words.give_back()
    stems = fit_sides(of(True))[0]
    words.give_back()
    return Model(*sides, stems)


def features(model: Model, begins: np.ndarray, hashes: np.ndarray, stems: np.ndarray) -> np.ndarray:
    """For each text, by words alone, pairs and stems: the mean log ratio of all its words and that of its likeliest stretches."""
    different, codes = np.unique(hashes, return_inverse=True)
    single = model.word(different)[codes].astype(np.float64)
    double = single.copy()
    if len(hashes) > 1:
        inner = np.ones(len(hashes), bool)
        inner[begins[:-1][np.diff(begins) > 0]] = False
        at = np.flatnonzero(inner)
        known = model.pair(pair_keys(hashes[at - 1], hashes[at]))
        double[at] = np.where(np.isnan(known), model.back(different)[codes[at - 1]] + single[at], known)
    different, codes = np.unique(stems, return_inverse=True)
    n, width = np.diff(begins), 1 + len(STRETCHES)
    some, ends = np.flatnonzero(n > 0), np.repeat(begins[1:], n)
    out = np.zeros((len(n), FEATURES))
    for k, values in enumerate((single, double, model.stem(different)[codes].astype(np.float64))):
        sums = np.concatenate([[0.0], np.cumsum(values)])
        whole = (sums[begins[1:]] - sums[begins[:-1]])[some] / n[some]
        columns = [whole]
        for size in STRETCHES:
            stretch = np.full(len(values), -np.inf)
            if len(values) >= size:
                stretch[: len(values) - size + 1] = (sums[size:] - sums[: len(values) - size + 1]) / size
            stretch[np.arange(len(values)) + size > ends] = -np.inf
            best = np.maximum.reduceat(stretch, begins[:-1][some]) if len(some) else np.zeros(0)
            columns.append(np.where(np.isfinite(best), best, whole))
        out[some, k * width : (k + 1) * width] = np.stack(columns, 1)
    return out


def probability(model: Model, x: np.ndarray, empty: np.ndarray) -> np.ndarray:
    if not len(model.weights):
        return np.full(len(x), model.prior)
    z = np.clip((x - model.means) / model.spreads, -8, 8) @ model.weights[1:] + model.weights[0]
    return np.where(empty, model.prior, 1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit_weights(model: Model, x: np.ndarray, y: np.ndarray, ordinary_share: float, prior: float) -> None:
    """Logistic regression of the features by Newton's method, with classes weighted as they occur among all labels."""
    model.prior = prior
    if len(set(y.tolist())) < 2:
        return
    model.means, model.spreads = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.hstack([np.ones((len(x), 1)), np.clip((x - model.means) / model.spreads, -8, 8)])
    weight = np.where(y == 1, prior / max(1, (y == 1).sum()), ordinary_share / max(1, (y == 0).sum())) * len(y)
    b, ridge = np.zeros(z.shape[1]), np.eye(z.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -40, 40)))
        step = np.linalg.solve((z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + ridge, z.T @ (weight * (y - p)) - ridge @ b)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    model.weights = b


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """The bounded sample of labelled documents: doc_id, whole text, toxic, fit; and how many labels of each class there are.

    Of each class and use the first by a hash of the id are taken, SAMPLE_DOCS at most.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter((fold != HELD_OUT) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known.withColumn("fit", fold == FIT), "labels")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64(F.col("doc_id"), F.lit(9))
    chosen = None
    for toxic in (0, 1):
        for fit in (False, True):
            part = known.filter((F.col("toxic") == toxic) & (F.col("fit") == fit)).orderBy(order).limit(SAMPLE_DOCS)
            chosen = part if chosen is None else chosen.unionByName(part)
    chosen = materialize(chosen.withColumnRenamed("doc_id", "l_id"), "chosen")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "toxic", "fit")
    # Of several texts with one id the one with the smallest digest counts, in whatever order rows are read.
    found = materialize(found.groupBy("doc_id", "toxic", "fit").agg(F.min_by("text", F.struct(F.sha2("text", 256).alias("d"))).alias("text")).select("doc_id", "text", "toxic", "fit"), "sample")
    return found, counts.get(0, 0), counts.get(1, 0)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from the sample's words alone: neither ids nor labels nor other columns are inputs of a score.

    Whole texts give counts, very long ones too; null texts give none. Of several texts of one id the one with the smallest digest counts, of
    several labels the toxic one. Without labels nothing is learnt: every text then scores 0.
    """
    texts, n_ordinary, n_toxic = sample(docs, labels, id_col, text_col)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            begins, *sequences = tokens(batch.column("text"))
            n = np.diff(begins)
            toxic = np.repeat(batch.column("toxic").to_numpy(zero_copy_only=False), n) == 1
            for stem, hashes in zip((False, True), sequences, strict=True):
                left = np.concatenate([[np.uint64(0)], hashes[:-1]]).astype(np.uint64)[: len(hashes)]
                left[begins[:-1][n > 0]] = 0
                both = pa.table({"v": left.view(np.int64), "w": hashes.view(np.int64), "ordinary": (~toxic).astype(np.int64), "toxic": toxic.astype(np.int64)})
                both = both.group_by(["v", "w"]).aggregate([("ordinary", "sum"), ("toxic", "sum")])
                columns = [both[c].combine_chunks() for c in ("v", "w", "ordinary_sum", "toxic_sum")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(both), stem))], names=["v", "w", "ordinary", "toxic", "stem"])

    counted = texts.filter("NOT fit").select("text", "toxic").mapInArrow(words.lean(pairs), "v long, w long, ordinary long, toxic long, stem boolean")
    model = fit_model(materialize(counted.groupBy("stem", "v", "w").agg(F.sum("ordinary").cast("int").alias("ordinary"), F.sum("toxic").cast("int").alias("toxic")), "counts"))
    shared = docs.sparkSession.sparkContext.broadcast(packed(model))
    names = [f"x{k}" for k in range(FEATURES)]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            x = features(unpacked(shared.value), *tokens(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(c) for c in x.T)], names=["toxic", *names])

    # Where too few labels are left for fitting, the documents that gave the counts serve for that too.
    known = texts.groupBy("fit", "toxic").count().collect()
    fit = "fit" if {r["toxic"] for r in known if r["fit"]} == {0, 1} else "true"
    got = texts.filter(fit).select("text", "toxic").mapInArrow(words.lean(describe), "toxic int, " + ", ".join(f"{n} double" for n in names)).toPandas()
    got = got.sort_values(["toxic", *names])
    total = max(1, n_ordinary + n_toxic)
    fit_weights(model, got[names].to_numpy(float), got["toxic"].to_numpy(), n_ordinary / total, n_toxic / total)
    shared.destroy()
    return model


def score(docs: DataFrame, model: Model | Broadcast, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """Returns doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold) for each row, and the columns of docs named in `keep`.

    Features of a text are length-normalised log-likelihood ratios of both classes: of the whole text and of its
    likeliest stretches, by single words, by pairs and by stems. A null or empty text, and one without words, scores the
    share of toxic labels. Very long texts are scored whole. Null ids aren't held out. Repeated rows and ties are scored each alike. An empty
    table gives an empty result. Other columns are returned if they are named in `keep`, and may have any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(packed(model)) if isinstance(model, Model) else model
    others = [c for c in keep if c not in (id_col, text_col)]
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"own_{c}") for c in others))
    back = ["doc_id", *["text"] * (text_col in keep), *(f"own_{c}" for c in others)]
    schema = ", ".join([*(f"`{c}` {own.schema[c].dataType.simpleString()}" for c in back), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words.forget()
        known = unpacked(shared.value)
        for batch in words.slices(batches, "text"):
            begins, *sequences = tokens(batch.column("text"))
            got = probability(known, features(known, begins, *sequences), np.diff(begins) == 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in back), pa.array(got)], names=[*back, "score"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    scored = own.mapInArrow(words.lean(run), schema)
    kept = [F.col("text" if c == text_col else f"own_{c}").alias(c) for c in keep if c != id_col]
    return scored.select("doc_id", *kept, held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def ordinary_of(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that aren't predicted toxic, with all their columns. Texts go to Python, but don't come back.

    Null, empty and very long texts, null ids and repeated rows are scored as score() does: equal rows stay or go together. An empty
    table stays empty; columns of docs may have any names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(packed(model))
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("key_hash"))
    scored = materialize(score(slim, shared, keep=("key_hash",)).select(F.col("doc_id").alias("key_id"), "key_hash", "predicted"), "scores")
    shared.destroy()
    return without(with_key(docs, id_col, text_col), scored.filter("predicted = 1")).select("row.*")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score(docs, learn(docs, labels))
