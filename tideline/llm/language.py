"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

Subwords are runs of 3 and 4 bytes of the UTF-8 text (A-Z lower-cased; digits, punctuation and white space are one
word boundary), hashed to ``BUCKETS`` embeddings. Their mean goes through one linear layer; since both are linear,
prediction adds up ready-made scores of each bucket over the whole text, however long.

Training takes a bounded sample: the ``DOCS_PER_LANG`` documents of each language with the smallest hash of doc_id and
text, and of each ``PIECES`` pieces of ``PIECE_CHARS`` characters at hashed places (shorter texts whole), so the driver holds at
most languages * DOCS_PER_LANG * PIECES * PIECE_CHARS characters. A fifth of these documents is not trained on; on
them the temperature and both rules of rejection are fitted, so that each turns away at most ``REJECTED`` of them: a
confidence (never above ``MOST``), and the share of subwords that training has met. A text of a language that was not
learned may look like one of those learned to the softmax, but many of its subwords were never seen. The share of a
text of n subwords may fall short by ``LEEWAY`` standard deviations, so short texts are not turned away for a rare word.

Null texts and texts without a letter are ``und`` with score 0 and rejected. Without labelled rows every text is
``und``. Null labels are not learned from. Rows are predicted one by one, so repeated rows get equal results. An
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import text
from tideline.llm.hashing import byte_slices

BUCKETS, WIDTH = 1 << 16, 16
DOCS_PER_LANG, PIECES, PIECE_CHARS = 600, 4, 300
EPOCHS, BATCH, RATE = 5, 64, 2.0
REJECTED, MOST, LEEWAY = 0.001, 0.4, 3.0

_code = np.arange(256)
LETTER = np.where((_code >= 65) & (_code <= 90), _code + 32, np.where(((_code >= 97) & (_code <= 122)) | (_code >= 128), _code, 32)).astype(np.uint32)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every subword; none reaches over two texts or is all boundary."""
    x = np.r_[LETTER[data], np.zeros(4, np.uint32)]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    three = x[:-4] | x[1:-3] << 8 | x[2:-2] << 16
    word = x[1:-3] != 32
    a = np.flatnonzero(word & (left >= 3))
    b = np.flatnonzero(word & (x[2:-2] != 32) & (left >= 4))
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    first = (three[a] * np.uint32(0x9E3779B1)) >> shift
    second = ((three[b] | x[3:-1][b] << 24) * np.uint32(0x85EBCA6B)) >> shift
    return np.concatenate([first, second]).astype(np.int64), np.concatenate([row[a], row[b]])


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # bucket -> score of each language
    bias: np.ndarray
    seen: np.ndarray  # buckets met in training
    sharpness: float = 1.0
    threshold: float = 0.0
    share: float = 0.0

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of each text, its number of subwords, and how many of them training has met."""
        bucket, row = grams(data, offsets)
        n = np.bincount(row, minlength=len(offsets) - 1)
        met = np.bincount(row, self.seen[bucket], len(offsets) - 1)
        sums = np.stack([np.bincount(row, self.scores[bucket, c], len(offsets) - 1) for c in range(len(self.langs))], 1)
        return sums / np.maximum(n, 1)[:, None] + self.bias, n, met


def strange(n: np.ndarray, met: np.ndarray, share: float) -> np.ndarray:
    """Texts with clearly fewer known subwords than ``share``."""
    return met < share * n - LEEWAY * np.sqrt(n * share * (1 - share))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def held_out(docs_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(docs_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame) -> list:
    """The training pieces: (lang, place, piece); pieces of one document have one place, a hash of doc_id and text."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("place"))
    room = F.greatest(F.lit(1), F.char_length("text") - PIECE_CHARS + 1)
    # Only the pieces go into the ranking, never whole texts.
    cut = F.transform(F.sequence(F.lit(1), F.lit(PIECES)), lambda k: F.substring("text", (F.pmod(F.xxhash64("place", k), room) + 1).cast("int"), F.lit(PIECE_CHARS)))
    first = Window.partitionBy("lang").orderBy("place")
    few = rows.select("lang", "place", cut.alias("pieces")).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= DOCS_PER_LANG)
    return few.select("lang", "place", F.explode("pieces").alias("piece")).distinct().collect()


def train(docs: DataFrame, seed: int = 7) -> Model | None:
    rows = sorted((r["lang"], r["place"], r["piece"]) for r in sample(docs))
    langs = sorted({lang for lang, _, _ in rows})
    if not langs:
        return None
    place = np.asarray([d for _, d, _ in rows])
    label = np.asarray([langs.index(lang) for lang, _, _ in rows])
    raw = [p.encode() for _, _, p in rows]
    offsets = np.r_[0, np.cumsum([len(p) for p in raw])]
    bucket, row = grams(np.frombuffer(b"".join(raw), np.uint8), offsets)
    order = np.argsort(row, kind="stable")
    bucket, ends = bucket[order], np.cumsum(np.bincount(row, minlength=len(rows)))
    parts = [bucket[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]
    apart = place % 5 == 0

    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    layer, bias = np.zeros((WIDTH, len(langs))), np.zeros(len(langs))
    learn = np.asarray([i for i in np.flatnonzero(~apart) if len(parts[i])], np.int64)
    steps = max(1, EPOCHS * -(-len(learn) // BATCH))
    done = 0
    for _ in range(EPOCHS if len(learn) else 0):
        rng.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            pick = learn[at:at + BATCH]
            n = np.asarray([len(parts[i]) for i in pick])
            flat = np.concatenate([parts[i] for i in pick])
            heads = np.r_[0, np.cumsum(n)[:-1]]
            mean = np.add.reduceat(table[flat], heads) / n[:, None]
            error = softmax(mean @ layer + bias)
            error[np.arange(len(pick)), label[pick]] -= 1
            rate = RATE * (1 - done / steps)
            back = error @ layer.T / n[:, None]
            layer -= rate * mean.T @ error / len(pick)
            bias -= rate * error.mean(0)
            sort = np.argsort(flat, kind="stable")
            cells = flat[sort]
            new = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
            table[cells[new]] -= rate * np.add.reduceat(np.repeat(back, n, 0)[sort], new)
            done += 1

    seen = np.zeros(BUCKETS, bool)
    for i in learn:
        seen[parts[i]] = True
    model = Model(langs, (table @ layer).astype(np.float32), bias.astype(np.float32), seen)
    check = np.flatnonzero(apart)
    if len(check):
        texts = [raw[i] for i in check]
        logits, n, met = model.logits(np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])])
        logits, truth = logits[n > 0], label[check][n > 0]
        if len(truth):
            grid = np.geomspace(0.25, 16, 49)
            loss = [-np.log(np.maximum(softmax(g * logits)[np.arange(len(truth)), truth], 1e-12)).mean() for g in grid]
            model.sharpness = float(grid[int(np.argmin(loss))])
            model.threshold = float(min(MOST, np.quantile(softmax(model.sharpness * logits).max(1), REJECTED)))
            n, met = n[n > 0], met[n > 0]
            model.share = next((x for x in np.arange(0.99, 0.0, -0.01).tolist() if strange(n, met, x).mean() <= REJECTED), 0.0)
    return model


def identify(docs: DataFrame, model: Model | None, prefix: str = "") -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and rejected; ``prefix`` keeps these names apart from columns of ``docs``."""
    added = [prefix + c for c in ("lang_pred", "score", "rejected")]
    if model is None:
        return docs.select("*", *[F.lit(v).alias(c) for c, v in zip(added, ("und", 0.0, True))])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of one number for each language
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            best, score, odd, no = [], [], [], batch.num_columns - 2
            for _, data, offsets in byte_slices(batch.column(no)):
                logits, n, met = m.logits(data, offsets)
                odd += strange(n, met, m.share).tolist()
                chance = softmax(m.sharpness * logits)
                best += [m.langs[i] for i in chance.argmax(1).tolist()]
                score += chance.max(1).tolist()
            letters = batch.column(no + 1).to_pylist()
            columns = batch.columns[:no]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([b if x else "und" for b, x in zip(best, letters)], pa.string()), pa.array([s if x else 0.0 for s, x in zip(score, letters)], pa.float64()),
                 pa.array([not x or s < m.threshold or o for s, x, o in zip(score, letters, odd)], pa.bool_())], [*names, *added])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    schema = docs.select("*", *[F.lit(v).alias(c) for c, v in zip(added, ("", 0.0, True))]).schema
    new = "i" + uuid.uuid4().hex[:12]
    return docs.select("*", text().alias(f"{new}_text"), letters.alias(f"{new}_letters")).mapInArrow(run, schema)
