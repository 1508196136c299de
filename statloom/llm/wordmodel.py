"""Quality by perplexity under an interpolated modified Kneser-Ney model of words of trusted text.

The model is over n-grams of up to `ORDER` words and grows with the text counted. Texts are read in
slices, and n-grams go by 64-bit keys. Order by order, from the highest down, each slice sends its
distinct keys, with what its trusted texts add to their counts, to the part that has this range of
keys; the part sums them and answers each slice in the order of its keys, so that answers need no keys.
Each n-gram has an owner among the slices that counted it; the owners' n-grams are the distinct ones
that the order below counts. A common n-gram takes one entry per slice, and none is held by a driver or
by all executors. Neither the table of the model nor a copy of the texts is stored; texts are read
again for each order and priced with the answers. A trusted document is priced by the model without
that document: otherwise its own n-grams would make it look better than any other text. Below single
words lies the spelling: the model of byte classes in `kneser` and, within a class, all bytes alike. It
is all that words not counted have.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import kneser
from statloom.llm import text as tx
from statloom.llm.kneser import GRID, QUANTILE, UNIT, as_perplexity, cuts, discounts_of, flag_trusted, verdict
from statloom.session import freed_shuffles, materialise

ORDER = 3
SLICE_BYTES = 4 << 20
START = np.uint64(0)
# Surprisal in units of a byte within its class.
WITHIN = np.rint(np.log(np.bincount(kneser.SYMBOL, minlength=1 << kneser.BITS))[kneser.SYMBOL] / UNIT).astype(np.int64)
PART_BYTES = 16 << 20
# Where the ranges of keys end that are asked one after the other, per order from the highest down. The
# first is the longer, as the answers to it are on disk while the next is asked.
TURNS = ((0.52, 1), (0.56, 1), (1,))
# In how many groups of slices texts meet their answers to be priced.
GROUPS = 3
ASKED = "part int, slice long, crc long, trusted boolean, n int, size long, body binary"
ANSWERS = f"{ASKED}, level int, n1 long, n2 long, n3 long, n4 long, entries long, total long"
TEXTS = "slice long, crc long, size long, body binary"
STATS = ("n1", "n2", "n3", "n4", "entries", "total")
ASKED_FIELDS = [("part", pa.int32()), ("slice", pa.int64()), ("crc", pa.int64()), ("trusted", pa.bool_()), ("n", pa.int32()), ("size", pa.int64()), ("body", pa.binary())]
ANSWER_FIELDS = [*ASKED_FIELDS, ("level", pa.int32()), *[(name, pa.int64()) for name in STATS]]


def key(*words: np.ndarray) -> np.ndarray:
    """Keys of n-grams given word by word."""
    value = np.zeros(len(words[0]), dtype=np.uint64)
    for word in words:
        value = value * tx.CHAIN + word
    return tx.mix(value ^ np.uint64(len(words)))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    left = ends - starts
    out = tx.mix(left.astype(np.uint64))
    rows, at = np.arange(len(starts)), starts
    while len(rows):
        n = np.minimum(left, 8).astype(np.uint64)
        chunk = eights[at].view("<u8").ravel() & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - n) << np.uint64(3)))
        out[rows] = tx.mix(out[rows] * tx.CHAIN + chunk)
        more = np.flatnonzero(left > 8)
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return out


def trigrams(data: np.ndarray, offsets: np.ndarray, spans: tuple | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The words two before, one before and at each place, with starts before the text, and its text."""
    starts, ends, owner = spans or tx.words(data, offsets)
    last = word_hashes(data, starts, ends)
    out = [last]
    for back in (1, 2):
        word = np.full(len(last), START, dtype=np.uint64)
        same = owner[back:] == owner[: len(owner) - back] if len(owner) > back else np.zeros(0, dtype=bool)
        word[back:][same] = last[: len(last) - back][same]
        out.insert(0, word)
    return out, owner


def pack(arrays: list[np.ndarray]) -> tuple[int, bytes]:
    """Arrays of whole numbers from 0 on as compressed bytes, and their size before."""
    out = []
    for values in arrays:
        width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
        out += [bytes([width]), *[(values >> values.dtype.type(8 * k)).astype(np.uint8).tobytes() for k in range(width)]]
    body = b"".join(out)
    return len(body), pa.compress(body, "zstd", asbytes=True)


def unpack(n: int, size: int, body: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(body, size, "zstd"), np.uint8)
    out, place = [], 0
    while place < size:
        width = int(raw[place])
        bytes_of = raw[place + 1 : place + 1 + n * width].reshape(width, n)
        value = bytes_of[0].astype(np.uint64)
        for k in range(1, width):
            value |= bytes_of[k].astype(np.uint64) << np.uint64(8 * k)
        out.append(value)
        place += 1 + n * width
    return out


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Numbered slices of about `SLICE_BYTES` of texts, all trusted or none; a longer text is a slice of its own."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        flags = batch.column(batch.schema.get_field_index("trusted"))
        for trusted in (False, True):
            rows = batch.filter(flags if trusted else pc.invert(flags))
            if not rows.num_rows:
                continue
            sizes = pc.fill_null(pc.binary_length(rows.column(rows.schema.get_field_index("body"))), 0).to_numpy(zero_copy_only=False)
            slices = (np.cumsum(sizes, dtype=np.int64) - sizes) // SLICE_BYTES
            edges = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), len(slices)]
            for begin, end in zip(edges, edges[1:]):
                yield number, trusted, rows.slice(begin, end - begin)
                number += 1


def texts_of(wanted: Callable[[int, bool], bool]) -> Callable:
    """The function that gives each slice wanted as one row, to meet its answers."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, trusted, rows in cut(batches):
            if not wanted(number, trusted):
                continue
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_batch(rows)
            body = sink.getvalue()
            columns = [[number], [checksum(rows)], [body.size], [pa.compress(body, "zstd", asbytes=True)]]
            yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["slice", "crc", "size", "body"])

    return packed


def checksum(rows: pa.RecordBatch) -> int:
    data, offsets = next(tx.pieces(rows.column(rows.schema.get_field_index("body")), 1 << 62))
    return zlib.crc32(offsets.tobytes(), zlib.crc32(data))


def unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, some place of each, and the number of the key at each place."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


class Slice:
    """The words of a slice of texts, with the distinct n-grams of each order."""

    def __init__(self, rows: pa.RecordBatch | pa.Table) -> None:
        bodies = rows.column(rows.schema.get_field_index("body"))
        bodies = bodies.combine_chunks() if isinstance(bodies, pa.ChunkedArray) else bodies
        bodies = pa.concat_arrays(bodies.chunks) if isinstance(bodies, pa.ChunkedArray) else bodies
        self.data, self.offsets = next(tx.pieces(bodies, 1 << 62))
        self.spans = tx.words(self.data, self.offsets)
        self.words, self.owner = trigrams(self.data, self.offsets, self.spans)
        self.trusted = rows.column(rows.schema.get_field_index("trusted")).to_numpy(zero_copy_only=False).astype(bool)
        self.counted = self.trusted[self.owner]

    def keys(self, level: int) -> np.ndarray:
        """The keys of an order at all places; below the highest, with that of a start at the end."""
        keys = key(*self.words[level:])
        return np.concatenate([keys, key(*[np.array([START])] * (ORDER - level))]) if level else keys

    def distinct(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """Distinct keys of an order, a place of each, the number of the key at each place, and that of
        the context of the order above. Contexts are the n-grams one place before, or starts."""
        if not level:
            return *unique(self.keys(0)), None
        found, first, number = unique(self.keys(level))
        context = np.full(len(number) - 1, number[-1])
        inside = np.flatnonzero(self.owner[1:] == self.owner[:-1]) + 1
        context[inside] = number[inside - 1]
        return found, first, number[:-1], context

    def adds(self, level: int, answers: dict[int, list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Distinct keys of an order, and what this slice adds for each: to its count, and as a context to
        the total and to the numbers of n-grams counted once, twice and more often."""
        if not level:
            keys, _, number, _ = self.distinct(0)
            return keys, [np.bincount(number[self.counted], minlength=len(keys))]
        keys, _, number, context = self.distinct(level)
        _, first, _, _ = self.distinct(level - 1)
        counts, owned = answers[level - 1][0], answers[level - 1][1].astype(bool)
        # The start is counted by nothing, so a first place is one of the n-gram where it is owned.
        at, counts = first[owned], counts[owned]
        size = len(keys)
        of = context[at]
        total = np.bincount(context[self.counted], minlength=size) if level == 1 else np.bincount(of, counts, size).astype(np.int64)
        held = [np.bincount(of[np.minimum(counts, 3) == k], minlength=size) for k in (1, 2, 3)]
        return keys, [np.bincount(number[at], minlength=size), total, *held]


def asked(number: int, crc: int, found: Slice, level: int, answers: dict, parts: int, now: range) -> Iterator[tuple]:
    """The rows that a slice sends to the parts `now`: keys, and what it adds if it is of trusted texts."""
    if not len(found.owner):
        return
    trusted = bool(found.trusted[0])
    if trusted:
        keys, adds = found.adds(level, answers)
    else:
        keys, adds = found.keys(level), []
        if len(now) < parts:
            keys = keys[(keys >= np.uint64((now[0] << 64) // parts)) & (keys <= np.uint64((now[-1] + 1 << 64) // parts - 1))]
        keys = np.sort(keys)
        keys = keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]
    ends = np.array([(part + 1 << 64) // parts - 1 for part in now], dtype=np.uint64)
    begin = int(np.searchsorted(keys, np.uint64((now[0] << 64) // parts)))
    for part, end in zip(now, np.searchsorted(keys, ends, "right").tolist()):
        if begin < end:
            own = keys[begin:end]
            gaps = np.concatenate([own[:1], np.diff(own)])
            size, body = pack([gaps, *[x[begin:end] for x in adds]])
            yield part, number, crc, trusted, end - begin, size, body
        begin = end


def answer(level: int) -> Callable:
    """The function that sums what slices sent to a part, and answers them."""

    def answered(part: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sent = [unpack(r["n"], r["size"], r["body"]) for r in rows]
        sizes = np.array([r["n"] for r in rows])
        keys = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in sent])
        found, _, number = unique(keys)
        none = [np.zeros(n, dtype=np.uint64) for n in sizes]
        adds = [np.concatenate([x[k] if len(x) > 1 else zeros for x, zeros in zip(sent, none)]).astype(np.int64) for k in range(1, 6 if level else 2)]
        del sent, keys
        summed = [np.bincount(number, x, len(found)).astype(np.int64) for x in adds]
        counting = np.flatnonzero(adds[0] > 0)
        owner = np.full(len(found), -1)
        owner[number[counting][::-1]] = counting[::-1]
        owned = np.zeros(len(number), dtype=np.int64)
        owned[owner[owner >= 0]] = 1
        counts = summed[0]
        stats = {f"n{k}": int((counts == k).sum()) for k in range(1, 5)} | {"entries": int((counts > 0).sum()), "total": int(counts.sum())}
        out, ends = [], np.cumsum(sizes)
        for row, begin, end in zip(rows, ends - sizes, ends):
            at = number[begin:end]
            size, body = pack([summed[0][at], owned[begin:end], *[x[at] for x in summed[1:]]])
            out.append(row | {"size": size, "body": body, "level": level} | stats)
            stats = dict.fromkeys(stats, 0)
        return pa.Table.from_pylist(out, schema=pa.schema(ANSWER_FIELDS))

    return answered


def collected(rows: pa.Table, crc: int) -> dict[int, list[np.ndarray]]:
    """What all parts answered a slice, per order, in the order of its keys."""
    parts: dict[int, list] = {}
    for r in sorted(rows.to_pylist(), key=lambda r: r["part"]):
        if r["crc"] != crc:
            raise RuntimeError("the documents came in another order when they were read again: write them first")
        parts.setdefault(r["level"], []).append(unpack(r["n"], r["size"], r["body"]))
    return {level: [np.concatenate(x).astype(np.int64) for x in zip(*found)] for level, found in parts.items()}


def opened(row: pa.Table) -> pa.Table:
    size, body = row.column("size")[0].as_py(), row.column("body")[0].as_py()
    return pa.ipc.open_stream(pa.decompress(body, size, "zstd")).read_all()


def ask_alone(level: int, parts: int, now: range) -> Callable:
    """The function for slices that need no answers to ask: those of texts that add nothing, and any for the highest order."""

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, trusted, rows in cut(batches):
            if not (level and trusted):
                yield from sent(asked(number, checksum(rows), Slice(rows), level, {}, parts, now)).to_batches()

    return asking


def ask_answered(level: int, parts: int, now: range) -> Callable:
    def asking(text: pa.Table, hits: pa.Table) -> pa.Table:
        number, crc = text.column("slice")[0].as_py(), text.column("crc")[0].as_py()
        return sent(asked(number, crc, Slice(opened(text)), level, collected(hits, crc), parts, now))

    return asking


def sent(rows: Iterator[tuple]) -> pa.Table:
    schema = pa.schema(ASKED_FIELDS)
    return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)


def counted(rows: DataFrame) -> tuple[list[DataFrame], dict]:
    """The answers to all slices of `rows` (`trusted`, `body`) per order from the highest down, and the
    discounts and totals of the model. Below the highest order, the count of an n-gram is the number of
    different words that come before it."""
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    answers, found = [], []
    for level in range(ORDER):
        ends = [0, *[-(-int(parts * 100 * end) // 100) for end in TURNS[level]]]
        done = None
        for now in [range(*x) for x in zip(ends, ends[1:]) if x[0] < x[1]]:
            asks = rows.mapInArrow(ask_alone(level, parts, now), ASKED)
            if level:
                texts = rows.mapInArrow(texts_of(lambda _, trusted: trusted), TEXTS)
                met = texts.groupBy("slice").cogroup(answers[-1].where("trusted").groupBy("slice"))
                asks = asks.unionByName(met.applyInArrow(ask_answered(level, parts, now), ASKED))
            said = materialise(asks.groupBy("part").applyInArrow(answer(level), ANSWERS), "answers")
            done = said if done is None else done.unionByName(said)
        answers.append(done)
        found.append(done.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in STATS]).first())
    d = [discounts_of([row[f"n{k}"] for k in range(1, 5)]) for row in found[::-1]]
    one = found[-1]
    return answers, {"discounts": d, "total": one.total, "held": held(d[0], one.n1, one.n2, one.entries - one.n1 - one.n2)}


def held(d: list[float], once: np.ndarray, twice: np.ndarray, more: np.ndarray) -> np.ndarray:
    return 0.0 + d[0] * once + d[1] * twice + d[2] * more


def spelling(trusted: DataFrame) -> np.ndarray:
    """Surprisals of all 32 ** 4 n-grams of byte classes: as many however much is counted."""
    found = kneser.model(trusted).toArrow()
    out = np.zeros(kneser.GRAMS, dtype=np.int32)
    out[found.column("g").to_numpy()] = found.column("cost").to_numpy()
    return out


def spelled(data: np.ndarray, offsets: np.ndarray, spans: tuple, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of the spelling probability of each word with the blank after it, and their bytes."""
    starts, ends, owner = spans
    code, _ = kneser.grams(data, offsets)
    running = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(table[code] + WITHIN[data], out=running[1:])
    stops = np.minimum(ends + 1, offsets[owner + 1])
    return (running[starts] - running[stops]) * UNIT, stops - starts


def grouped(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A place of each distinct key of a text, the number of each place's key, and how often."""
    _, first, number = unique(keys ^ tx.mix(owner.astype(np.uint64) + np.uint64(1)))
    return first, number, np.bincount(number)


def without_own(grams, contexts, keys, context_keys, owner, discount, whole) -> tuple[list, list, list]:
    """Counts and context totals as if each text had not been counted; all exact but for rounding.

    `grams`, `contexts`, `keys` and `context_keys` go from the highest order down.
    """
    counts, totals, helds = [], [], []
    first, number, own = grouped(keys[0], owner)
    loss = own
    for level in range(ORDER):
        before = grams[level][first]
        after = before - loss
        counts.append(after[number])
        lost = discount[level][np.minimum(before, 3)] - discount[level][np.minimum(after, 3)]
        if level < ORDER - 1:
            at = context_keys[level][first]
            _, group, _ = grouped(at, owner[first])
            total = contexts[level][0][first] - np.bincount(group, loss)[group].astype(np.int64)
            rest = contexts[level][1][first] - np.bincount(group, lost)[group]
            totals.append(total[number])
            helds.append(np.maximum(rest, 0)[number])
            gone = (after == 0).astype(np.int64)
            next_first, next_number, _ = grouped(keys[level + 1], owner)
            loss = np.bincount(next_number[first], gone, minlength=len(next_first)).astype(np.int64)
            first, number = next_first, next_number
        else:
            of = owner[first]
            size = int(owner.max()) + 1
            totals.append((whole["total"] - np.bincount(of, loss, size).astype(np.int64))[owner])
            helds.append(np.maximum(whole["held"] - np.bincount(of, lost, size), 0)[owner])
    return counts, totals, helds


def costs(found: Slice, answers: dict[int, list[np.ndarray]], whole: dict, base: np.ndarray) -> np.ndarray:
    """Surprisal in units of each word. `base` are logarithms of the spelling probabilities."""
    counts, contexts = [], []
    for level in range(ORDER):
        _, _, number, context = found.distinct(level)
        counts.append(answers[level][0][number])
        if level:
            d = whole["discounts"][ORDER - level]
            contexts.append([answers[level][2][context], held(d, *answers[level][3:])[context]])
    owner = found.owner
    discount = [np.array([0.0, *d]) for d in whole["discounts"][::-1]]
    totals = [contexts[0][0], contexts[1][0], np.full(len(owner), whole["total"])]
    helds = [contexts[0][1], contexts[1][1], np.full(len(owner), float(whole["held"]))]
    mine = np.flatnonzero(found.counted)
    if len(mine):
        part = lambda arrays: [x[mine] for x in arrays]
        a, b, c = found.words
        keys, context_keys = part([key(a, b, c), key(b, c), key(c)]), part([key(a, b), key(b)])
        new = without_own(part(counts), [part(x) for x in contexts], keys, context_keys, owner[mine], discount, whole)
        for old, values in zip((counts, totals, helds), new):
            for target, value in zip(old, values):
                target[mine] = value
    log_p = base.copy()
    for level in range(ORDER - 1, -1, -1):
        seen = np.flatnonzero(totals[level] > 0)
        n, t = counts[level][seen], totals[level][seen]
        with np.errstate(divide="ignore"):
            lower = np.log(helds[level][seen] / t) + log_p[seen]
            more = np.flatnonzero(n > 0)
            own = np.log(np.maximum(n[more] - discount[level][np.minimum(n[more], 3)], 0) / t[more])
            lower[more] = np.logaddexp(own, lower[more])
        log_p[seen] = lower
    return np.rint(-log_p / UNIT).astype(np.int64)


def in_group(number: int | Column, group: int) -> bool | Column:
    return (number % 4294967291) % GROUPS == group


def price(whole: dict, table: np.ndarray) -> Callable:
    """The function that prices the texts of a slice with the answers to it."""

    def priced(text: pa.Table, hits: pa.Table) -> pa.Table:
        rows, crc = opened(text), text.column("crc")[0].as_py()
        found = Slice(rows)
        cost = lengths = np.zeros(0, dtype=np.int64)
        if len(found.owner):
            base, lengths = spelled(found.data, found.offsets, found.spans, table)
            cost = costs(found, collected(hits, crc), whole, base)
        bounds = np.searchsorted(found.owner, np.arange(rows.num_rows + 1))
        n = np.diff(bounds)
        cost, n_bytes = (np.diff(np.concatenate([[0], np.cumsum(values)])[bounds]).astype(np.int64) for values in (cost, lengths))
        mean = pa.array(cost // np.maximum(n_bytes, 1) // GRID, mask=n == 0)
        kept = [rows.column(name) for name in ("doc_id", "lang", "trusted")]
        return pa.table([*kept, pa.array(n), mean], names=["doc_id", "lang", "trusted", "n_grams", "mean_cost"])

    return priced


def perplexity(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = QUANTILE,
) -> DataFrame:
    """One row per input row: `doc_id`, `lang`, `trusted`, `n_grams`, `perplexity`, `cut`, `kept`.

    `trusted_ids` has the ids of trusted documents in `doc_id`; `n_grams` is the number of words and
    `perplexity` is per byte, so that languages with long words and short ones are cut alike. A row
    is kept if its perplexity is at most `SLACK` times the cut of its language; a language, or null,
    without trusted text takes the cut over all trusted text, and without any all texts pass. Null,
    empty and blank texts have no perplexity and are not kept. Null ids are never trusted; repeated rows
    get the same result; an empty table gives no rows; other columns are ignored. Rows are read several
    times and must come in the same order each time, as those of files do; otherwise this ends with an error.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("body"))
    rows = flag_trusted(rows, trusted_ids.where(F.col("doc_id").isNotNull()))
    with freed_shuffles(rows.sparkSession):
        letters = spelling(rows.where("trusted").select("body"))
        answers, whole = counted(rows.select("trusted", "body"))
        hits = answers[0].unionByName(answers[1]).unionByName(answers[2])
        out = T.StructType([*rows.select("doc_id", "lang", "trusted").schema.fields, *[T.StructField(c, T.LongType()) for c in ("n_grams", "mean_cost")]])
        scored = None
        for group in range(GROUPS):
            texts = rows.mapInArrow(texts_of(lambda number, _, group=group: in_group(number, group)), TEXTS)
            met = texts.groupBy("slice").cogroup(hits.where(in_group(F.col("slice"), group)).groupBy("slice"))
            part = materialise(met.applyInArrow(price(whole, letters), out), "perplexities")
            scored = part if scored is None else scored.unionByName(part)
    own = cuts(scored, True, quantile).select(F.col("lang").alias("of_lang"), F.col("cut").alias("own_cut"))
    pooled = cuts(scored, False, quantile).select(F.col("cut").alias("all_cut"))
    languages = scored.select("lang").distinct().join(own, F.col("lang").eqNullSafe(F.col("of_lang")), "left").drop("of_lang")
    bounds = materialise(languages.join(pooled, F.lit(True), "left").select(F.col("lang").alias("of_lang"), F.coalesce("own_cut", "all_cut").alias("cut")), "cuts")
    joined = scored.join(bounds, F.col("lang").eqNullSafe(F.col("of_lang"))).drop("of_lang")
    return joined.select("doc_id", "lang", "trusted", "n_grams", as_perplexity("mean_cost").alias("perplexity"), as_perplexity("cut").alias("cut"), verdict().alias("kept"))
