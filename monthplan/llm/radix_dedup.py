"""Suffix-array dedup by a depth-limited radix sort: which bytes lie in a window that also starts earlier.

Suffixes are ordered only through the window's length, digit by digit, the most significant first. Passes drop every
suffix that is alone with its digits; what is still together after the last one are exactly the repeated windows.

1. first digit: the anchor gram. One row stands for each run of windows with a common anchor (``radix_core``); equal
   runs of one chunk of documents are settled where they are read, and only the first of them is sent on. The rows are
   shuffled by the gram, sorted, and streamed: equal runs but the first are removed, a run alone with its gram drops
   out, and first runs that share a gram with different runs stay open.
2. second digit: an open run is split into its windows that reach far to the left and those that reach far to the
   right of the gram, each with that many more bytes as key; halves alone with their key drop out.
3. last digit: the windows of what is left, one by one, by all their bytes (128 bits of hash).

Groups are streamed from sorted partitions, never gathered: a common passage costs a long run, not memory. The removed
ranges of a document, bounded by its length, meet its text in one join that the second pass uses too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .radix_core import Rolling, anchors, forget
from .tables import carried_schema, read_table, ship_package, stored, text_pieces

SIZE = 100
GRAM = 36
VERSION_COL = "_text_version"
NO_ID = -(1 << 63)  # stands for a null id, before all others
CHUNK_BYTES = 1_000_000  # bytes whose digits are worked out together: about 150 bytes of memory each
VERSION = 31  # a place is the low bits, above them 16 bits of a hash of the text: rows that share an id keep theirs apart

_RUNS = "first long, second long, doc long, place long, sure boolean"
_PLACES = "doc long, lo long, stop long, off int"


def merged(lo: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges joined, in order."""
    order = np.argsort(lo, kind="stable")
    lo, stop = lo[order], np.maximum.accumulate(stop[order]) if len(stop) else stop
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > stop[:-1]
    heads = np.flatnonzero(new)
    return lo[heads], stop[np.r_[heads[1:] - 1, len(lo) - 1]] if len(heads) else stop


def _later(new_group: np.ndarray, doc: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Rows of sorted groups that stand at another place than the first of their group."""
    head = np.flatnonzero(new_group)[np.cumsum(new_group) - 1]
    return (doc != doc[head]) | (lo != lo[head])


def _changed(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """(ids, texts, versions) of documents of about ``size`` bytes together; one at least."""
    ids: list[int] = []
    raws: list[bytes] = []
    versions: list[int] = []
    held = 0
    for piece in text_pieces(batches, max_bytes=size):
        for doc, text, version in zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            ids.append(doc)
            raws.append(raw)
            versions.append(version)
            held += len(raw)
            if held >= size:
                yield ids, raws, versions
                ids, raws, versions, held = [], [], [], 0
    if ids:
        yield ids, raws, versions


def _pieces(raws: list[bytes], size: int, chunk: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(which text, where it begins, its bytes) in runs of about ``chunk`` bytes.

    A longer text is cut where every ``chunk`` of its windows ends: the pieces share ``size - 1`` bytes and no window.
    """
    which, begins, parts, held = [], [], [], 0
    for k, raw in enumerate(raws):
        for begin in range(0, max(1, len(raw) - size + 1), chunk):
            part = raw if len(raw) <= chunk else raw[begin:begin + chunk + size - 1]
            if parts and held + len(part) > 2 * chunk:
                yield which, begins, parts
                which, begins, parts, held = [], [], [], 0
            which.append(k)
            begins.append(begin)
            parts.append(part)
            held += len(part)
            if part is raw:
                break
    if parts:
        yield which, begins, parts


def _bounds(raws: list[bytes]) -> np.ndarray:
    return np.cumsum([0, *map(len, raws)])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def first_digit(size: int, gram: int, chunk: int):
    """Map side of the first pass: settle what a chunk settles by itself, send the rest on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, raws, versions in _chunks(batches, chunk):
            whole: dict[bytes, int] = {}
            digests = [xxhash.xxh3_128_digest(r) for r in raws]
            for d, i in zip(digests, ids, strict=True):
                whole[d] = min(i, whole.get(d, i))
            copies = [(i, v << VERSION, (v << VERSION) + len(r)) for d, i, r, v in zip(digests, ids, raws, versions, strict=True)
                      if whole[d] != i and len(r) >= size]
            mine, seen = [], set()
            for k, (d, i) in enumerate(zip(digests, ids, strict=True)):
                if whole[d] == i and d not in seen:  # a repeated row is the same document
                    seen.add(d)
                    mine.append(k)
            raws = [raws[k] for k in mine]
            own, base = np.array([ids[k] for k in mine], np.int64), np.array([versions[k] for k in mine], np.int64) << VERSION
            for which, begins, parts in _pieces(raws, size, chunk):
                yield settled(own[which], base[which] + np.array(begins, np.int64), parts, copies)
                copies = []
        forget()

    def settled(ids: np.ndarray, begins: np.ndarray, parts: list[bytes], sure: list[tuple]) -> pa.RecordBatch:
        bounds = _bounds(parts)
        a = anchors(np.frombuffer(b"".join(parts), np.uint8), bounds, size, gram)
        doc, shift = ids[a["doc"]], (begins - bounds[:-1])[a["doc"]]
        lo, stop = a["lo"] + shift, a["end"] + shift
        order = np.lexsort((lo, doc, a["second"], a["first"]))
        first, second, doc, lo, stop = a["first"][order], a["second"][order], doc[order], lo[order], stop[order]
        off = (a["at"] - a["lo"])[order]
        head = _changed(first, second)
        later = _later(head, doc, lo)
        by_doc = np.argsort(doc[later], kind="stable")
        late_doc, late_lo, late_stop = doc[later][by_doc], lo[later][by_doc], stop[later][by_doc]
        cuts = [*np.flatnonzero(_changed(late_doc)), len(late_doc)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            begin, end = merged(late_lo[x:y], late_stop[x:y])
            sure += zip([int(late_doc[x])] * len(begin), begin.tolist(), end.tolist(), strict=True)
        n, m = int(head.sum()), len(sure)
        s = np.array(sure, np.int64).reshape(m, 3)
        place = (lo << 16 | (stop - lo) << 8 | off)[head]
        return pa.RecordBatch.from_arrays([
            pa.array(np.r_[_signed(first[head]), s[:, 0] * 0x9E3779B97F4A7C1 + s[:, 1]]),
            pa.array(np.r_[_signed(second[head]), s[:, 2]]), pa.array(np.r_[doc[head], s[:, 0]]),
            pa.array(np.r_[place, s[:, 1]]), pa.array(np.arange(n + m) >= n)], names=[c.split()[0] for c in _RUNS.split(", ")])

    return run


def _place_batch(doc: np.ndarray, lo: np.ndarray, stop: np.ndarray, off: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(lo, pa.int64()), pa.array(stop, pa.int64()),
                                       pa.array(off, pa.int32())], names=["doc", "lo", "stop", "off"])


def settle_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream runs sorted by (first, second, doc, place): removed ranges with off -1, open runs with their offset.

    Only the first row of the digest group at hand is carried over from one batch to the next, with whether its gram
    has been seen with several digests and whether it has been given out.
    """
    carry: tuple | None = None  # (first, second, doc, place, several, given)
    for batch in batches:
        first, second, doc, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        sure = batch.column(4).to_numpy(zero_copy_only=False)
        if sure.any():
            yield _place_batch(doc[sure], place[sure], second[sure], np.full(int(sure.sum()), -1))
            first, second, doc, place = first[~sure], second[~sure], doc[~sure], place[~sure]
        if not len(first):
            continue
        several, given = False, False
        if carry:
            first, second, doc, place = (np.r_[np.int64(c), x] for c, x in zip(carry[:4], (first, second, doc, place), strict=True))
            several, given = carry[4:]
        new_gram = _changed(first)
        head = _changed(first, second)
        lo, stop, off = place >> 16, (place >> 16) + (place >> 8 & 0xFF), place & 0xFF
        later = _later(head, doc, lo)
        if later.any():
            yield _place_batch(doc[later], lo[later], stop[later], np.full(int(later.sum()), -1))
        gram = np.cumsum(new_gram) - 1
        many = np.bincount(gram, weights=head) >= 2
        many[0] |= several
        open_ = head & many[gram]
        open_[0] &= not given
        if open_.any():
            yield _place_batch(doc[open_], lo[open_], stop[open_], off[open_])
        last = int(np.flatnonzero(head)[-1])
        carry = (first[last], second[last], doc[last], place[last], bool(many[-1]), bool(many[-1]))


def second_digit(size: int, gram: int, chunk: int):
    """Open runs of a document with its text -> (key, doc, lo, body) of their left- and right-reaching windows."""
    half = (size - gram) // 2
    near = 2 * size  # no run reaches further than this from where it begins

    def regions(piece: pa.RecordBatch) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
        """(doc, where the region begins with its version, its bytes, its open runs): texts, long ones in parts."""
        for doc, text, version, opens in zip(*(piece.column(i).to_pylist() for i in range(4)), strict=True):
            if not opens:
                continue
            raw, base = text.encode("utf-8", "surrogatepass"), version << VERSION
            rows = np.array([(r["lo"] - base, r["stop"] - base, r["off"]) for r in opens], np.int64)
            for part in np.unique(rows[:, 0] // chunk):
                begin = max(0, int(part) * chunk)
                held = rows[rows[:, 0] // chunk == part]
                yield doc, base + begin, raw[begin:begin + chunk + near], held - (begin, begin, 0)

    def grouped(piece: pa.RecordBatch) -> Iterator[list]:
        group, held = [], 0
        for region in regions(piece):
            group.append(region)
            held += len(region[2])
            if held >= chunk:
                yield group
                group, held = [], 0
        if group:
            yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches, max_bytes=chunk):
            for group in grouped(piece):
                ids, begins, raws, opens = zip(*group, strict=True)
                joined = b"".join(raws)
                bounds = _bounds(list(raws))
                which = np.repeat(np.arange(len(group)), [len(o) for o in opens])
                rows = np.concatenate(opens)
                base, shift = bounds[which], np.array(begins, np.int64)[which] - bounds[which]
                lo, stop, at = base + rows[:, 0], base + rows[:, 1], base + rows[:, 0] + rows[:, 2]
                rolling = Rolling(np.frombuffer(joined, np.uint8), 0)
                far_left = lo <= at - half  # has windows that start half or more before the anchor
                far_right = stop - size > at - half
                left = (at - half, at + gram, lo, np.minimum(stop, at - half + size), far_left)
                right = (at, at + size - half + 1, np.maximum(lo, at - half + 1), stop, far_right)
                for side, (a, b, begin, end, have) in enumerate((left, right)):
                    a, b, begin, end = a[have], b[have], begin[have], end[have]
                    if not len(a):
                        continue
                    key = _signed(rolling.of(a, b) ^ np.uint64(side))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key), pa.array(np.array(ids, np.int64)[which[have]]), pa.array(begin + shift[have], pa.int64()),
                        pa.array([joined[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())],
                        names=["key", "doc", "lo", "body"])
        forget()

    return run


def windows(size: int):
    """Stream halves sorted by key: every window of those that are not alone with their key, as (w1, w2, doc, lo)."""

    def spread(docs: list, los: list, bodies: list[bytes]) -> pa.RecordBatch:
        bounds = _bounds(bodies)
        data = np.frombuffer(b"".join(bodies), np.uint8)
        counts = np.diff(bounds) - size + 1
        body = np.repeat(np.arange(len(bodies)), counts)
        step = np.arange(len(body)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = bounds[body] + step
        w = [_signed(Rolling(data, i).of(start, start + size)) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(w[0]), pa.array(w[1]), pa.array(np.array(docs, np.int64)[body]),
                                           pa.array(np.array(los, np.int64)[body] + step, pa.int64())],
                                          names=["w1", "w2", "doc", "lo"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # (key, doc, lo, body, whether it has been given out)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = list(zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns), strict=True))
                out = []
                for row in rows:
                    if held and held[0] == row[0]:
                        if not held[4]:
                            out.append(held[1:4])
                        out.append(row[1:])
                        held = (*row, True)
                    else:
                        held = (*row, False)
                if out:
                    yield spread(*map(list, zip(*out, strict=True)))
        forget()

    return run


def repeated(size: int):
    """Stream windows sorted by (w1, w2, doc, lo): those at another place than the first, as ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: tuple | None = None
        for batch in batches:
            w1, w2, doc, lo = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            lo = lo.astype(np.int64)
            if not len(w1):
                continue
            if carry:
                w1, w2, doc, lo = (np.r_[np.int64(c), x] for c, x in zip(carry, (w1, w2, doc, lo), strict=True))
            head = _changed(w1, w2)
            later = _later(head, doc, lo)
            last = int(np.flatnonzero(head)[-1])
            carry = (w1[last], w2[last], doc[last], lo[last])
            if later.any():
                yield _place_batch(doc[later], lo[later], lo[later] + size, np.full(int(later.sum()), -1))

    return run


def cut(batches: Iterator[pa.RecordBatch], with_text: bool, carry: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """(doc, text, version, ranges, carried) -> the digest row of each document, what is left of it, and the carried columns."""
    for piece in text_pieces(batches):
        rows = []
        for doc, text, version, ranges in zip(*(piece.column(i).to_pylist() for i in range(4)), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            places = np.array([(r["lo"], r["stop"]) for r in ranges or ()], np.int64).reshape(-1, 2) - (version << VERSION)
            lo, stop = merged(places[:, 0], np.minimum(places[:, 1], len(raw)))
            at, left = 0, []
            for a, b in zip(lo.tolist(), stop.tolist(), strict=True):
                left.append(raw[at:a])
                at = b
            left.append(raw[at:])
            rest = b"".join(left)
            rows.append((None if doc == NO_ID else doc, len(raw), len(raw) - len(rest), len(lo),
                         hashlib.sha256(rest).hexdigest(), rest if with_text else None))
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        found = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        yield pa.RecordBatch.from_arrays([*found, *piece.columns[4:]],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *carry])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, gram: int = GRAM,
                   with_text: bool = True, carry: Sequence[str] = (), chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (if ``with_text``) kept: one row for each row of ``docs``,
    with the columns to carry along.

    Bytes of the UTF-8 texts that lie in a ``size``-byte string which also starts earlier (smaller id, or the same
    document further left) are removed, as judged on the input. Null text counts as empty; null ids come before all
    others; a repeated row is the same document and doesn't count against itself. Rows that repeat an id with another
    text, null ids too, stand one after the other, in the order of 16 bits of a hash of their text, which also keeps what is
    found in them apart. The removed bytes may cut a character: ``kept`` is binary. Long texts are worked on in pieces
    of ``chunk_bytes``.
    """
    if not (gram < size <= 255 and size - gram <= 255):
        raise ValueError("windows of up to 255 bytes, grams shorter than them")
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                        *[F.col(f"`{c}`") for c in carry]).withColumn(f"{VERSION_COL}", F.pmod(F.xxhash64("text"), F.lit(1 << 16)))
    same = ["doc", VERSION_COL]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sorted_by(df: DataFrame, key: str, *order: str) -> DataFrame:
        return df.repartition(parts, key).sortWithinPartitions(key, *order)

    runs = texts.select("doc", "text", VERSION_COL).mapInArrow(first_digit(size, gram, chunk_bytes), _RUNS)
    places = stored(sorted_by(runs, "first", "second", "doc", "place").mapInArrow(settle_first, _PLACES), "radix-first")
    version = F.shiftright("lo", VERSION).alias(VERSION_COL)
    opens = places.where("off >= 0").groupBy("doc", version).agg(F.collect_list(F.struct("lo", "stop", "off")).alias("places"))
    halves = texts.join(opens, same, "left").select("doc", "text", VERSION_COL, "places").mapInArrow(
        second_digit(size, gram, chunk_bytes), "key long, doc long, lo long, body binary")
    late = sorted_by(halves, "key").mapInArrow(windows(size), "w1 long, w2 long, doc long, lo long")
    late = sorted_by(late, "w1", "w2", "doc", "lo").mapInArrow(repeated(size), _PLACES)
    ranges = places.where("off < 0").unionByName(late).groupBy("doc", version).agg(
        F.collect_list(F.struct("lo", "stop")).alias("places"))
    out = texts.join(ranges, same, "left").select("doc", "text", VERSION_COL, "places", *carry).mapInArrow(
        lambda batches: cut(batches, with_text, carry),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary" + carried_schema(docs, carry))
    return out if with_text else out.drop("kept")


def op9_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), with_text=False)
