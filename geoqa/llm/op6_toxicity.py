"""Operator 6 - toxicity by averaged subword-bag embeddings and a linear softmax.

A word (A-Z lower-cased, cut at ASCII marks) is the mean of the vectors of its
hashed byte n-grams, with word borders, and of the whole word; a text is the mean
of its words; a linear softmax gives two classes.  Vectors and softmax are trained
jointly in numpy on a bounded sample of labelled rows, so an unseen misspelling
scores by the n-grams it shares.  After training each n-gram needs one number (its
vector times the difference of the two class weights), so the broadcast model is
``BUCKETS`` floats, and a text of any length is scored whole in one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoqa.llm import textscan as T
from geoqa.llm.common import arrow_map, crc32_of_id, give_back, only, table

BUCKETS, DIM, GRAMS = 1 << 17, 4, (3, 4, 5, 6)
#: Bounds of the training sample: rows of each label.
POSITIVE_ROWS, NEGATIVE_ROWS = 2000, 4000
EPOCHS, RATE, DECAY, SCALE = 80, 0.05, 1e-3, 32.0
#: An n-gram is trained if its share of label 1 differs from the sample's by so many nats.
EVIDENCE = 8.0
#: Neutral words that every text's mean includes, so that a text of three words is not decided by one.
PAD = 10
CUTOFF = 0.3
#: Bytes of words whose n-grams are made at a time.
PIECE = 1 << 19


_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_IP = np.uint64(pow(int(_P), -1, 1 << 64))
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _gram_keys(text: np.ndarray, at: list[np.ndarray], size: list) -> list[np.ndarray]:
    """Hashes of the byte ranges ``text[at:at + size]``, the same wherever they stand."""
    c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[text] * _powers(len(text), _P))))
    ip = _powers(len(text) + 1, _IP)
    return [(c[a + n] - c[a]) * ip[a] for a, n in zip(at, size)]


def _buckets(key: np.ndarray, buckets: int) -> np.ndarray:
    return (T.mix(key) >> np.uint64(40)).astype(np.int64) % buckets


def _framed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in lower case with their borders, one after the other: (bytes, first byte, size of each)."""
    size = end - start + 2
    first = np.cumsum(size) - size
    text = np.empty(int(size.sum()), np.uint8)
    text[np.repeat(first + 1, size - 2) + T.spans(size - 2)] = data[np.repeat(start, size - 2) + T.spans(size - 2)]
    upper = (text >= 65) & (text <= 90)
    upper[first] = upper[first + size - 1] = False
    text[upper] += 32
    text[first], text[first + size - 1] = 0x3C, 0x3E
    return text, first, size


def subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int = BUCKETS,
             grams: tuple[int, ...] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of ``<word>`` and of the word itself."""
    text, first, size = _framed(data, start, end)
    words, at, n_of = [np.arange(len(size))], [first], [size]
    for n in grams or GRAMS:
        many = np.maximum(size - n + 1, 0)
        at.append(np.repeat(first, many) + T.spans(many))
        words.append(np.repeat(np.arange(len(size)), many))
        n_of.append(n)
    key = _gram_keys(text, at, n_of)
    key[0] += np.uint64(7)
    return np.concatenate(words), _buckets(np.concatenate(key), buckets)


def _long_word_score(data: np.ndarray, start: int, end: int, bucket_score: np.ndarray) -> float:
    """Mean score of the subwords of one word of any length, ``PIECE`` bytes at a time."""
    total = float(bucket_score[_buckets(T.byte_keys(data, np.array([start]), np.array([end]), lower=True), len(bucket_score))[0]])
    count, longest = 1, max(GRAMS)
    for lo in range(start, end, PIECE):
        hi = min(lo + PIECE + longest - 1, end)
        text = _framed(data, np.array([lo]), np.array([hi]))[0][int(lo > start):]
        last = hi == end
        if not last:
            text = text[:-1]
        stop = len(text) if last else int(lo == start) + PIECE  # n-grams that begin here
        at = [np.arange(max(0, min(stop, len(text) - n + 1))) for n in GRAMS]
        key = np.concatenate(_gram_keys(text, at, list(GRAMS)))
        total += float(bucket_score[_buckets(key, len(bucket_score))].sum())
        count += len(key)
        if last:
            break
    return total / count


def word_scores(data: np.ndarray, start: np.ndarray, end: np.ndarray, bucket_score: np.ndarray) -> np.ndarray:
    """Mean score of each word's subwords, in blocks of words of about ``PIECE`` bytes."""
    out = np.zeros(len(start))
    size = end - start
    block = np.where(size > PIECE, -1, np.cumsum(size) // PIECE)
    for b in np.unique(block[block >= 0]).tolist():
        i = np.flatnonzero(block == b)
        which, gram = subwords(data, start[i], end[i], len(bucket_score))
        out[i] = np.bincount(which, bucket_score[gram], len(i)) / np.maximum(np.bincount(which, minlength=len(i)), 1)
    for i in np.flatnonzero(block < 0).tolist():
        out[i] = _long_word_score(data, int(start[i]), int(end[i]), bucket_score)
    return out


def _bags(docs: DataFrame) -> DataFrame:
    """``id, y, words, counts``: distinct words of each row of (id, text, y) that has words."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in T.chunks(b.column(1)):
                w = T.scan(data, offs, T.ALNUM, lower=True)
                f, rows, words, counts = w.first(), [], [], []
                for i in range(hi - lo):
                    if f[i + 1] > f[i]:
                        _, first, n = np.unique(w.key[f[i]:f[i + 1]], return_index=True, return_counts=True)
                        rows.append(lo + i)
                        words.append([w.text(f[i] + j).decode().translate(_ASCII_LOWER) for j in first])
                        counts.append(n.tolist())
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(2).take(take), pa.array(words, pa.list_(pa.string())),
                                                  pa.array(counts, pa.list_(pa.int32()))], ["id", "y", "words", "counts"])

    return arrow_map(docs, run, f"id {id_type}, y int, words array<string>, counts array<int>")


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    positive: int = POSITIVE_ROWS, negative: int = NEGATIVE_ROWS) -> tuple[pa.Table, float | None]:
    """(bags, share of label 1 among all usable labels).  The sampled ids - at most
    ``positive + negative``, taken in hash order - are broadcast to the documents."""
    y = only(labels, id=id_col, y=label_col).where("y in (0, 1) and id is not null").groupBy("id").agg(F.max("y").cast("int").alias("y"))
    y = y.where(crc32_of_id(F.col("id")) % 4 != 2)
    share = y.agg(F.avg("y")).first()[0]
    order = F.xxhash64("id", F.lit(6))
    chosen = y.where("y = 1").orderBy(order, "id").limit(positive).union(y.where("y = 0").orderBy(order, "id").limit(negative))
    rows = only(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id").select("id", "text", "y")
    return _bags(rows).toArrow(), share


def telling(y, doc, word, gram_word, gram, buckets: int) -> np.ndarray:
    """Which buckets occur in rows of label 1 clearly more, or less, often than by chance: rows x
    KL(share of label 1 among the rows that have it, share among all) >= ``EVIDENCE``.  The rest keep
    a zero vector; otherwise thousands of rare n-grams learn the sample's rows by heart."""
    by = np.argsort(gram_word, kind="stable")
    each = np.bincount(gram_word, minlength=int(word.max()) + 1)
    first, grams = np.cumsum(each) - each, gram[by]
    rows = np.zeros((2, buckets))
    step = 200
    edge = np.searchsorted(doc, np.arange(0, len(y) + step, step))
    for lo, hi in zip(edge[:-1], edge[1:]):  # some rows at a time, to bound memory
        n = each[word[lo:hi]]
        g = grams[np.repeat(first[word[lo:hi]], n) + T.spans(n)]
        seen = np.unique(np.repeat(doc[lo:hi], n) * buckets + g)
        for label in (0, 1):
            rows[label] += np.bincount(seen[y[seen // buckets] == label] % buckets, minlength=buckets)
    total, q = rows.sum(0), y.mean()
    p = rows[1] / np.maximum(total, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(p > 0, p * np.log(p / q), 0) + np.where(p < 1, (1 - p) * np.log((1 - p) / (1 - q)), 0)
    return (total > 0) & (total * kl >= EVIDENCE)


def train(bags: pa.Table, share: float | None, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """(score of each bucket, intercept): a text's log-odds are the intercept plus the mean over its
    words of the mean score of their subwords.  With one class only, everything gets its prior."""
    bags = bags.sort_by("id").combine_chunks()  # the same model whatever the order of rows
    y = bags.column("y").to_numpy().astype(float)
    p = min(max(y.mean() if len(y) else 0.0, 0.01), 0.99)
    prior = np.zeros(buckets, np.float32), float(np.log(p / (1 - p)))
    if not len(y) or y.min() == y.max():
        return prior
    lists = bags.column("words").combine_chunks()
    doc = np.repeat(np.arange(len(y)), pc.list_value_length(lists).to_numpy())
    index = lists.flatten().dictionary_encode()
    word, vocabulary = index.indices.to_numpy().astype(np.int64), index.dictionary
    count = bags.column("counts").combine_chunks().flatten().to_numpy().astype(float)
    del bags, lists, index
    weight = count / (np.bincount(doc, count) + PAD)[doc]
    known = np.bincount(word, minlength=len(vocabulary)) > 1  # words of one document teach nothing about others
    if not known.any():
        return prior
    keep = known[word]
    doc, word, weight = doc[keep], word[keep], weight[keep]
    new = np.cumsum(known) - 1
    word = new[word]
    data, offs = T.buffer_of(vocabulary.filter(pa.array(known)))
    parts = []
    for lo in range(0, len(offs) - 1, 1 << 14):  # some words at a time: the n-grams' keys are large
        end = offs[lo + 1:lo + 1 + (1 << 14)]
        which, g = subwords(data, offs[lo:lo + len(end)], end, buckets)
        parts.append(((which + lo).astype(np.int32), g.astype(np.int32)))
    gram_word, gram = (np.concatenate(x) for x in zip(*parts))
    del parts
    taught = telling(y, doc, word, gram_word, gram, buckets)
    used = np.flatnonzero(taught)
    n_grams = np.bincount(gram_word).astype(float)
    place = np.zeros(buckets, np.int64)
    place[used] = np.arange(len(used))
    gram_word, gram = gram_word[taught[gram]], place[gram[taught[gram]]]
    rng = np.random.default_rng(6)
    vec = rng.uniform(-1 / dim, 1 / dim, (len(used), dim))
    soft = rng.normal(0, 0.1, (dim, 2))
    bias = np.zeros(2)
    # rows weigh so that both classes together have their natural shares
    row = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    row /= row.sum()
    target = np.stack((1 - y, y), 1)
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (vec, soft, bias)]
    for t in range(1, epochs + 1):
        words = np.stack([np.bincount(gram_word, vec[gram, d], len(n_grams)) for d in range(dim)], 1) / n_grams[:, None]
        texts = SCALE * np.stack([np.bincount(doc, weight * words[word, d], len(y)) for d in range(dim)], 1)
        z = texts @ soft + bias
        z = np.exp(z - z.max(1, keepdims=True))
        err = (z / z.sum(1, keepdims=True) - target) * row[:, None]
        g_text = SCALE * err @ soft.T
        g_word = np.stack([np.bincount(word, weight * g_text[doc, d], len(n_grams)) for d in range(dim)], 1) / n_grams[:, None]
        g_vec = np.stack([np.bincount(gram, g_word[gram_word, d], len(used)) for d in range(dim)], 1)
        for x, g, (m, v) in zip((vec, soft, bias), (g_vec, texts.T @ err, err.sum(0)), state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= RATE * ((m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8) + (DECAY * x if x is not bias else 0))
    del word, doc, weight, gram_word, gram, words, texts
    give_back()
    score = np.zeros(buckets, np.float32)
    score[used] = SCALE * vec @ (soft[:, 1] - soft[:, 0])
    return score, float(bias[1] - bias[0])


def score_column(col: pa.Array, model: tuple[np.ndarray, float]) -> np.ndarray:
    """Probability of label 1 of each text."""
    bucket_score, bias = model
    out = [np.zeros(0)]
    for lo, hi, data, offs in T.chunks(col):
        w = T.scan(data, offs, T.ALNUM, lower=True)
        _, first, place = np.unique(w.key, return_index=True, return_inverse=True)
        word = word_scores(data, w.start[first], w.end[first], bucket_score)
        total = np.bincount(w.doc, word[place], hi - lo) / (w.counts() + PAD)
        out.append(1 / (1 + np.exp(-np.clip(total + bias, -500, 500))))
    return np.concatenate(out)


def score_texts(df: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` (probability of label 1) of every row; null or wordless text gets the model's prior."""
    docs = only(df, id=id_col, text=text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score_column(b.column(1), shared.value))], ["id", "score"])

    return arrow_map(docs, run, f"id {docs.schema['id'].dataType.simpleString()}, score double")


def without_toxic(df: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``df``, whole, that score below ``cutoff``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(score_column(b.column(at), shared.value) < cutoff))

    return arrow_map(df, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema))


def toxicity(df: DataFrame, labelled: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """``id, held_out, score, predicted`` of every row of ``df``; the model learns from the documents
    ``labelled`` whose crc32 of the id is not 2 mod 4.  Rows keep their number; no labels: prior 0.01."""
    bags, share = training_sample(labelled, labels, id_col, text_col, label_col)
    out = score_texts(df, train(bags, share), id_col, text_col)
    return out.select("id", (crc32_of_id(F.col("id")) % 4 == 2).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, docs, table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")
