"""Language identification by a linear-chain conditional random field over the words of a text.

Each word gets a score per language from its affixes and n-grams (hashed byte n-grams, with a blank
at either end) and from a lexicon; transitions between the languages of neighbouring words are learnt
with them. Forward-backward gives every word its language marginals, also in code-switched text, and
a text takes the language with the largest sum of them.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import text as tx

ORDERS = (2, 3, 4)
BUCKETS = 1 << 15
BLOCK = 64
LOWERED_ROWS = 512
SLICE_BYTES = 1 << 20
STRETCH_WORDS = 16
LETTER = np.zeros(256, dtype=bool)
LETTER[np.r_[0x41:0x5B, 0x61:0x7B, 0x80:0x100]] = True
ASCII_LETTER = LETTER & (np.arange(256) < 0x80)
UNKNOWN = "und"


@dataclass
class Crf:
    labels: list[str]
    grams: np.ndarray  # (orders * BUCKETS, labels)
    lexicon: np.ndarray  # sorted word hashes
    lexical: np.ndarray  # (words of the lexicon + 1, labels); the last row is for other words
    moves: np.ndarray  # (labels, labels), log potentials

    def emissions(self, types: Types) -> np.ndarray:
        return types.sum_rows(self.grams) + self.lexical[types.lexicon_places(self.lexicon)]


class Types:
    """Distinct words of a slice with the hashed features of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        hashes = tx.span_hashes(data, starts, ends)
        self.hashes, first, self.of_token = np.unique(hashes, return_index=True, return_inverse=True)
        lengths = ends[first] - starts[first]
        edges = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.begins = edges[:-1]
        flat = np.full(edges[-1] + max(ORDERS), 0x20, dtype=np.uint32)
        inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        flat[np.repeat(self.begins + 1, lengths) + inner] = data[np.repeat(starts[first], lengths) + inner]
        self.features = [self._grams(flat, edges[-1], n, k) for k, n in enumerate(ORDERS)]

    @staticmethod
    def _grams(flat: np.ndarray, size: int, n: int, k: int) -> np.ndarray:
        """Row of each n-gram by the place where it begins, or the last row where it leaves the word."""
        code = np.zeros(size, dtype=np.uint32)
        valid = np.ones(size, dtype=bool)
        for i in range(n):
            part = flat[i : i + size]
            code = code * np.uint32(0x01000193) + part
            if 0 < i < n - 1:
                valid &= part != 0x20
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        return np.where(valid, (code >> np.uint32(17)) + np.uint32(k * BUCKETS), np.uint32(len(ORDERS) * BUCKETS)).astype(np.int64)

    def sum_rows(self, table: np.ndarray) -> np.ndarray:
        if not len(self.begins):
            return np.zeros((0, table.shape[1]))
        return sum(np.add.reduceat(table[f], self.begins, axis=0) for f in self.features)

    def spread_rows(self, by_type: np.ndarray, rows: int) -> np.ndarray:
        """The transpose of `sum_rows`."""
        widths = np.diff(np.append(self.begins, len(self.features[0])))
        every = np.repeat(by_type, widths, axis=0)
        places = np.concatenate(self.features)
        columns = [np.bincount(places, np.tile(every[:, k], len(ORDERS)), rows) for k in range(by_type.shape[1])]
        return np.stack(columns, axis=1)

    def lexicon_places(self, lexicon: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(lexicon, self.hashes), max(len(lexicon) - 1, 0))
        return np.where(lexicon[at] == self.hashes, at, len(lexicon)) if len(lexicon) else np.zeros(len(self.hashes), int)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each entry of the first axis divided by its sum."""
    return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)


def forward_backward(potentials: np.ndarray, offsets: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward and backward vectors of each word of texts given by `offsets`.

    Texts are cut into blocks of `BLOCK` words. The product of a block's transfer matrices carries
    vectors across it, so all blocks are worked on side by side and a long text costs no long loop.
    """
    n, k = potentials.shape
    sizes = np.diff(offsets)
    blocks = -(-sizes // BLOCK)
    text_of = np.repeat(np.arange(len(sizes)), blocks)
    first = np.cumsum(blocks) - blocks
    number = np.arange(len(text_of)) - first[text_of]
    begin = offsets[text_of] + number * BLOCK
    length = np.minimum(BLOCK, offsets[text_of + 1] - begin)
    order = np.argsort(-length, kind="stable")
    alive = [int(np.searchsorted(-length[order], -t, "left")) for t in range(BLOCK + 1)]
    at = lambda t: begin[order[: alive[t]]] + t  # noqa: E731  words in place t of the blocks that reach it

    across = np.tile(np.eye(k), (len(order), 1, 1))
    for t in range(BLOCK if blocks.max(initial=0) > 1 else 0):
        m = alive[t]
        across[:m] = scaled((across[:m] @ moves) * potentials[at(t)][:, None, :])
    into = np.full((len(order), k), 1.0 / k)
    out = np.ones((len(order), k))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    for b in range(1, blocks.max(initial=0)):
        these = first[blocks > b] + b
        into[rank[these]] = scaled((into[rank[these - 1]][:, None, :] @ across[rank[these - 1]])[:, 0, :])
        those = first[blocks > b] + blocks[blocks > b] - b
        out[rank[those - 1]] = scaled((across[rank[those]] @ out[rank[those]][:, :, None])[:, :, 0])

    forward, backward = np.empty((n, k)), np.empty((n, k))
    state = into
    for t in range(BLOCK):
        m = alive[t]
        state[:m] = scaled((state[:m] @ moves) * potentials[at(t)])
        forward[at(t)] = state[:m]
    state = out
    for t in reversed(range(BLOCK)):
        m = alive[t]
        backward[at(t)] = state[:m]
        state[:m] = scaled((state[:m] * potentials[at(t)]) @ moves.T)
    return forward, backward


def word_marginals(crf: Crf, types: Types, offsets: np.ndarray) -> np.ndarray:
    scores = crf.emissions(types)
    potentials = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    forward, backward = forward_backward(potentials[types.of_token], offsets, np.exp(crf.moves))
    return scaled(forward * backward)


def train(texts: list[str], labels: list[np.ndarray], names: list[str], steps: int = 60, rate: float = 0.15, decay: float = 1e-4) -> Crf:
    """Fit on sequences of words, each with a label per word, by the likelihood gradient (Adam)."""
    data = np.frombuffer("\n".join(texts).encode(), np.uint8)
    starts, ends, _ = tx.runs(LETTER[data], np.array([0, len(data)]))
    types = Types(data, starts, ends)
    truth = np.concatenate(labels)
    k = len(names)
    offsets = np.cumsum([0, *map(len, labels)])
    common = np.bincount(types.of_token, minlength=len(types.hashes)) >= 3
    lexicon = types.hashes[common]
    crf = Crf(names, np.zeros((len(ORDERS) * BUCKETS + 1, k)), lexicon, np.zeros((len(lexicon) + 1, k)), np.zeros((k, k)))
    places = types.lexicon_places(lexicon)
    inside = np.ones(len(truth), dtype=bool)
    inside[offsets[1:] - 1] = False
    before = np.flatnonzero(inside)
    gold = np.eye(k)[truth]
    gold_moves = np.zeros((k, k))
    np.add.at(gold_moves, (truth[before], truth[before + 1]), 1)
    params = [crf.grams, crf.lexical, crf.moves]
    momentum, power = [[np.zeros_like(p) for p in params] for _ in range(2)]
    for step in range(1, steps + 1):
        scores = crf.emissions(types)
        potentials = (np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30)[types.of_token]
        moves = np.exp(crf.moves)
        forward, backward = forward_backward(potentials, offsets, moves)
        node = gold - scaled(forward * backward)
        edge = scaled(forward[before][:, :, None] * moves * (potentials * backward)[before + 1][:, None, :]).sum(axis=0)
        by_type = np.stack([np.bincount(types.of_token, node[:, c], len(types.hashes)) for c in range(k)], axis=1)
        lexical = np.stack([np.bincount(places, by_type[:, c], len(lexicon) + 1) for c in range(k)], axis=1)
        lexical[-1] = 0
        grams = types.spread_rows(by_type, len(crf.grams))
        grams[-1] = 0
        for i, gradient in enumerate((grams, lexical, gold_moves - edge)):
            gradient = gradient / len(truth) - decay * params[i]
            momentum[i] = 0.9 * momentum[i] + 0.1 * gradient
            power[i] = 0.99 * power[i] + 0.01 * gradient**2
            fixed = (momentum[i] / (1 - 0.9**step)) / (np.sqrt(power[i] / (1 - 0.99**step)) + 1e-9)
            params[i] += rate * (1 - step / (steps + 1)) * fixed
    return crf


def lower_slices(texts: pa.Array):
    """Slices of the lower-cased texts with their words: data, text offsets, starts, ends, owners.

    Texts are lower-cased a few at a time, so that a batch is not held twice, and what a slice took is
    given back before the next one."""
    for start in range(0, len(texts), LOWERED_ROWS):
        for data, offsets in tx.pieces(pc.utf8_lower(texts.slice(start, LOWERED_ROWS)), SLICE_BYTES):
            yield data, offsets, *tx.runs(LETTER[data], offsets)
        pa.default_memory_pool().release_unused()


def sample_stretches(most: int):
    """Up to `most` stretches of `STRETCH_WORDS` words, spread evenly over each text. A text of fewer
    words is one shorter stretch."""

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def sample(texts: pa.Array) -> pa.Array:
        rows = []
        for data, offsets, starts, ends, owner in lower_slices(texts):
            bounds = np.searchsorted(owner, np.arange(len(offsets)))
            for a, b in zip(bounds[:-1], bounds[1:]):
                whole = (b - a) // STRETCH_WORDS
                chosen = np.unique(np.linspace(0, whole - 1, min(whole, most)).astype(int)) if whole else []
                cut = [range(a + c * STRETCH_WORDS, a + (c + 1) * STRETCH_WORDS) for c in chosen] or [range(a, b)]
                rows.append([[data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace") for i in c] for c in cut if len(c)])
        return pa.array(rows, pa.list_(pa.list_(pa.string())))

    return sample


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = 400,
    stretches_per_text: int = 4,
    most_languages: int = 256,
    seed: int = 7,
) -> Crf:
    """Train on at most `rows_per_language` different texts of each language, none of them held out,
    and on `stretches_per_text` stretches of 16 words of each; a shorter text is learnt whole.

    Copies count once: texts are drawn by a hash of the text, at a rate that the number of different
    texts of a language fixes, with room so that few texts are all drawn; what is drawn is reduced to
    one row per text before it is collected. With more than `most_languages` languages those of the
    most texts are learnt. Half the training sequences join stretches of two texts, so switches of
    language are seen.
    """
    usable = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    hashed = usable.select(F.col(lang_col).alias("language"), F.col(text_col).alias("text"), F.xxhash64(text_col, F.lit(seed)).alias("h"))
    sizes = hashed.groupBy("language").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    counts = {r[0]: r[1] for r in sizes.orderBy(F.desc("n"), "language").limit(most_languages).collect()}
    if not counts:
        return Crf([], np.zeros((1, 0)), np.zeros(0, np.uint64), np.zeros((1, 0)), np.zeros((0, 0)))
    rates = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 1.5 * rows_per_language / max(n, 1)))])
    drawn = hashed.where(F.pmod("h", F.lit(1 << 40)) < rates[F.col("language")] * F.lit(float(1 << 40)))
    single = drawn.groupBy("language", "h").agg(F.first("text").alias("text"))
    rows = single.select("language", "h", sample_stretches(stretches_per_text)("text").alias("s")).collect()
    names = sorted(counts)
    rng = np.random.default_rng(seed)
    stretches = []
    for label, name in enumerate(names):
        own = sorted((r["h"] % (1 << 40), r["h"], r["s"]) for r in rows if r["language"] == name and r["s"])[:rows_per_language]
        stretches += [(label, s) for _, _, parts in own for s in parts]
    if not stretches:
        return Crf(names, np.zeros((len(ORDERS) * BUCKETS + 1, len(names))), np.zeros(0, np.uint64), np.zeros((1, len(names))), np.zeros((len(names), len(names))))
    partner = rng.integers(len(stretches), size=len(stretches))
    same = rng.random(len(stretches)) < 0.5
    texts, labels = [], []
    for i, (label, s) in enumerate(stretches):
        other = (label, s) if same[i] else stretches[partner[i]]
        texts.append(" ".join(s + other[1]))
        labels.append(np.repeat([label, other[0]], [len(s), len(other[1])]))
    return train(texts, labels, names)


def predictor(model: Broadcast):
    @F.arrow_udf("lang_pred string, score double, certainty double")
    def predict(texts: pa.Array) -> pa.Array:
        crf = model.value
        langs, scores, sure, k = [], [], [], len(crf.labels)
        for data, offsets, starts, ends, owner in lower_slices(texts):
            n = len(offsets) - 1
            bounds = np.searchsorted(owner, np.arange(n + 1))
            marginals = word_marginals(crf, Types(data, starts, ends), bounds) if k else np.zeros((len(owner), 0))
            sums = np.stack([np.bincount(owner, marginals[:, c], n) for c in range(k)], axis=1) if k else np.zeros((n, 0))
            best = sums.argmax(axis=1) if k else np.zeros(n, int)
            share = (sums.max(axis=1) if k else np.zeros(n)) / np.maximum(np.diff(bounds), 1)
            clear = np.bincount(owner, marginals.max(axis=1), n) / np.maximum(np.diff(bounds), 1) if k else np.zeros(n)
            plain = np.diff(np.concatenate([[0], np.cumsum(ASCII_LETTER[data])])[offsets]) > 0
            for i in range(n):
                lettered = plain[i] or has_letter(data[offsets[i] : offsets[i + 1]])
                langs.append(crf.labels[best[i]] if lettered and k else UNKNOWN)
                scores.append(float(min(share[i], 1.0)) if lettered and k else 0.0)
                sure.append(float(min(clear[i], 1.0)) if lettered and k else 0.0)
        columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.float64())]
        return pa.StructArray.from_arrays(columns, ["lang_pred", "score", "certainty"])

    return predict


def has_letter(data: np.ndarray) -> bool:
    return bool((data >= 0x80).any()) and any(unicodedata.category(c)[0] == "L" for c in data.tobytes().decode("utf-8", "replace"))


def classify(docs: DataFrame, crf: Crf, text_col: str = "text") -> Column:
    """The struct (`lang_pred`, `score`, `certainty`) of each text; null, empty and letterless texts are
    `und`. `score` is the mean share of the one language, `certainty` the mean over words of the
    largest share: high as well for a text of several languages whose words are clear."""
    return predictor(docs.sparkSession.sparkContext.broadcast(crf))(F.col(text_col))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: `doc_id`, `held_out`, `lang_pred`, `score`, `certainty`.

    Learns from rows that are not held out and have id, text and language; labels that are too noisy
    to learn from need no care here. Null and empty texts, and texts without a letter, are `und` with
    score 0, as are all texts if there is nothing to learn from. Equal sums go to the first language
    in order. Repeated rows and null ids are rows like others; other columns are ignored. Scoring
    needs no shuffle; the model has a fixed size per language.
    """
    guess = classify(docs, fit(docs, id_col, text_col, lang_col), text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), guess.alias("g"))
    return rows.select("doc_id", "held_out", "g.*")
