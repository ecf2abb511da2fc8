"""Operator 6: exact removal of repeated passages by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document of smaller doc_id, or
earlier in the same one.  Strings never cross documents and are judged on the input.

1. Anchors.  The smallest hash of the ``GRAM``-byte strings inside a LENGTH-byte string names its shard, so that equal
   strings fall into the same shard wherever they are.  A run of places with the same name becomes one segment.  A name
   that occurs in one run alone in the whole corpus cannot belong to a repeat; only the names, in packed rows, are
   shuffled to find those that occur twice.  A name that a task meets twice is known to repeat, so that a task sends each
   name once, however frequent it is.
2. Segments.  Blocks of documents cut out the segments of repeated names.  Of equal segments of a block the earliest goes
   on to the shards; the others are repeats as they are.
3. Shards.  Each shard's segments, in parts of bounded size, get a suffix array by Larsson-Sadakane refinement and common
   prefixes by Kasai; entries that share LENGTH bytes are one class.  A part holds whole names; only a name of more bytes is
   split, and the classes of its parts are merged by binary search in sorted fingerprints (two 64-bit hashes).  All but a
   class's earliest place are repeats.
4. The repeats go back to the blocks of their documents, which drop the bytes that they cover.

Frequent strings make poor anchors: what many documents share would send a segment of each of them, with the text around
it, to one shard.  So a sample of documents tells which GRAM-byte strings are frequent, and such a string names a place only
where all others are frequent too.  Which strings those are moves places between shards; it changes no result.

Defined results: a null text is empty; rows with null doc_id come first; rows that share a doc_id are different documents
in the order of a hash of their texts; an empty table gives an empty result; other columns stay, but for those that have
the names of the results.  In the text that ``remove_repeats`` returns, bytes of characters that were cut are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, cut, mix64, slices, trim
from .suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 100, 24
#: Bytes of text in a block of documents, and of segments in a part of a shard.
BLOCK_BYTES, PART_BYTES = 8 << 20, 2 << 20
#: Frequent strings: bytes of text that the sample has (or this share of the corpus, if that is more), how often a string
#: occurs in the corpus by the sample (and at least in it), and how many are broadcast.  Only strings whose hash lies below
#: LOW are asked for; the others are seldom the smallest.
SAMPLE_BYTES, SAMPLE_SHARE, OFTEN, OFTEN_LEAST, MOST = 32 << 20, 1 / 256, 2000, 64, 1 << 18
LOW = np.uint64(1 << 62)
_TOP = np.uint64(1 << 63)
#: Names of the columns that the steps add to the documents.
UID, BLOCK = "__uid", "__block"
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_ODD = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(77)) | np.uint64(1)
NAMES = "bucket int, name binary, uid binary, start binary, size binary, told binary"
WANTED = "block int, name binary, uid binary, start binary, size binary"
SEGMENTS = "shard int, name binary, uid binary, start binary, size binary, bytes binary, rest_uid binary, rest_start binary, rest_end binary"
SPANS = "block int, uid binary, start binary, end binary"


def joined(x: np.ndarray, step: int, k: int) -> np.ndarray:
    """Hashes of twice the length, from those of ``step`` bytes."""
    return x[:-step] * _ODD[k] + x[step:]


def slide(x: np.ndarray, window: int, least: np.ufunc) -> np.ndarray:
    """The least (or, with np.maximum, the greatest) of each window of neighbours."""
    width = 1
    while 2 * width <= window:
        x = least(x[:-width], x[width:])
        width *= 2
    return least(x[: len(x) - (window - width)], x[window - width :]) if window > width else x


def grams(text: np.ndarray) -> np.ndarray:
    """Hashes below 2**63 of the GRAM-byte strings."""
    x8 = joined(joined(joined(_BYTE[text], 1, 0), 2, 1), 4, 2)
    x16 = joined(x8, 8, 3)
    return mix64(x16[:-8] * _ODD[4] + x8[16:]) >> np.uint64(1)


def runs(text: np.ndarray, size: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of places with one name, for texts one after another: (name, text's number, first place within it, places, own).

    A place's name is the smallest hash of a GRAM-byte string inside the LENGTH bytes from there; those in often (sorted)
    come after all others.  own: whether the run itself has its name twice, so that it can repeat within.
    """
    none = np.zeros(0, np.int64)
    if len(text) < LENGTH:
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    gram = grams(text)
    if len(often):
        low = np.flatnonzero(gram < LOW)
        at = np.minimum(np.searchsorted(often, gram[low]), len(often) - 1)
        gram[low[often[at] == gram[low]]] |= _TOP
    window = LENGTH - GRAM + 1
    name = slide(gram, window, np.minimum)
    first = np.cumsum(size) - size
    valid = (np.arange(len(text)) + LENGTH <= np.repeat(first + size, size))[: len(name)]
    # a string names some place if it is the greatest name of the places that see it; of one name, those that a
    # window sees together follow each other
    edge = np.zeros(window - 1, np.uint64)
    named = np.flatnonzero(gram == slide(np.concatenate([edge, np.where(valid, name, 0), edge]), window, np.maximum))
    twice = (gram[named[1:]] == gram[named[:-1]]) & (np.diff(named) < window)
    at = np.flatnonzero(valid)
    of = np.repeat(np.arange(len(size)), size)[at]
    name = name[at]
    new = np.ones(len(at), bool)
    new[1:] = (name[1:] != name[:-1]) | (of[1:] != of[:-1])
    begin = np.flatnonzero(new)
    name = name[begin]
    return name, of[begin], at[begin] - first[of[begin]], np.diff(np.append(begin, len(at))), np.isin(name, gram[named[1:]][twice])


def column(rows: list, name: str, kind: str) -> np.ndarray:
    data = b"".join([r[name] for r in rows])
    return np.frombuffer(data, kind) if data else np.zeros(0, kind)


def dealt(key: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[str, bytes]]]:
    """Packed columns for each value of key."""
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    value, first = np.unique(key[order], return_index=True)
    for v, a, b in zip(value.tolist(), first, [*first[1:], len(key)], strict=True):
        yield v, {c: x[order[a:b]].tobytes() for c, x in columns.items()}


def batch_of(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(name, b"") for r in rows], pa.int32() if kind == "int" else pa.binary()) for name, kind in fields], names=[f[0] for f in fields])


def send_names(parts: int, often):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", limit=PART_BYTES):
            data = [t.encode() for t in batch.column("text").to_pylist()]
            text = np.frombuffer(b"".join(data), np.uint8)
            name, of, start, size, own = runs(text, np.array([len(x) for x in data], np.int64), often.value)
            if not len(name):
                continue
            uid = batch.column(UID).to_numpy()[of]
            order = np.argsort(name, kind="stable")
            new = np.ones(len(name), bool)
            new[1:] = name[order[1:]] != name[order[:-1]]
            first = np.flatnonzero(new)
            twice = (np.diff(np.append(first, len(name))) > 1) | own[order[first]]
            told = np.full(len(name), 2, np.uint8)  # a name's other runs, which are known to repeat
            told[order[first]] = twice
            bucket = np.where(told == 2, (mix64(uid.view(np.uint64)) + start.astype(np.uint64)) % np.uint64(parts), mix64(name) % np.uint64(parts)).astype(np.int32)
            columns = {"name": name, "uid": uid.astype(np.int64), "start": start.astype(np.uint32), "size": size.astype(np.uint32), "told": told}
            yield batch_of([{"bucket": k, **c} for k, c in dealt(bucket, columns)], NAMES)

    return run


def repeated(blocks: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        name, uid, start, size, told = (column(rows, c, k) for c, k in (("name", "<u8"), ("uid", "<i8"), ("start", "<u4"), ("size", "<u4"), ("told", "u1")))
        order = np.argsort(name, kind="stable")
        order = order[told[order] < 2]
        x = name[order]
        same = np.zeros(len(x) + 1, bool)
        same[1:-1] = x[1:] == x[:-1]
        wanted = told >= 1
        wanted[order[same[1:] | same[:-1]]] = True
        # a name known to repeat in one task repeats for all
        block = uid[wanted] % blocks
        out = [{"block": k, **c} for k, c in dealt(block, {"name": name[wanted], "uid": uid[wanted], "start": start[wanted], "size": size[wanted]})]
        return pa.Table.from_batches([batch_of(out, WANTED)])

    return run


def cut_out(parts: int):
    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        rows = wanted.to_pylist()
        out = []
        if rows and docs.num_rows:
            text = {u: t.encode() for u, t in zip(docs.column(UID).to_pylist(), docs.column("text").to_pylist(), strict=True)}
            name, uid, start, size = (column(rows, c, k) for c, k in (("name", "<u8"), ("uid", "<i8"), ("start", "<u4"), ("size", "<u4")))
            order = np.lexsort((start, uid))
            name, uid, start, end = name[order], uid[order], start[order].astype(np.int64), start[order].astype(np.int64) + size[order] + LENGTH - 1
            seen: dict[bytes, int] = {}
            keep = np.zeros(len(uid), bool)
            for i, (u, a, b) in enumerate(zip(uid.tolist(), start.tolist(), end.tolist(), strict=True)):
                if seen.setdefault(text[u][a:b], i) == i:
                    keep[i] = True
            data = list(seen)
            at = np.flatnonzero(keep)
            shard = (mix64(name[at]) % np.uint64(parts)).astype(np.int32)
            columns = {"name": name[at], "uid": uid[at], "start": start[at].astype(np.uint32), "size": (end - start)[at].astype(np.uint32), "row": np.arange(len(at))}
            for k, c in dealt(shard, columns):
                own = np.frombuffer(c.pop("row"), np.int64).tolist()
                out.append({"shard": k, **c, "bytes": b"".join([data[i] for i in own])})
            rest = np.flatnonzero(~keep)
            for k, c in dealt((rest % parts).astype(np.int32), {"rest_uid": uid[rest], "rest_start": start[rest].astype(np.uint32), "rest_end": end[rest].astype(np.uint32)}):
                out.append({"shard": k, **c})
        return pa.Table.from_batches([batch_of(out, SEGMENTS)])

    return run


def fingerprints(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the LENGTH bytes from each of some places on."""
    out = []
    for turn in (0, 8):
        x = _BYTE[text] ^ _ODD[turn]
        step, k = 1, turn
        while 2 * step <= LENGTH:
            x = joined(x, step, k)
            step, k = 2 * step, k + 1
        out.append(mix64(x[at] * _ODD[k] + x[at + LENGTH - step]))
    return out[0], out[1]


def classes(text: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The valid places in the suffix array's order, and the number of the class of each: neighbours that share LENGTH bytes."""
    order = suffix_array(text)
    shared = common_prefixes(text, order, LENGTH)
    group = np.cumsum(shared < LENGTH)
    ok = valid[order]
    return order[ok], group[ok]


def parts_of(size: np.ndarray, name: np.ndarray, limit: int) -> list[tuple[int, int, bool]]:
    """Parts of segments in the order of their names: (first, behind the last, whether it goes on with the name of the part before).

    Only a name of more than limit bytes is split.  Strings of different names differ, so only its parts have classes in common.
    """
    end = np.cumsum(size)
    begin, out, a = end - size, [], 0
    edges = [0, *(np.flatnonzero(name[1:] != name[:-1]) + 1).tolist(), len(name)]
    for i, j in zip(edges, edges[1:], strict=False):
        if a < i and end[j - 1] - begin[a] > limit:
            out.append((a, i, False))
            a = i
        if a == i and j > i and end[j - 1] - begin[i] > limit:
            part = (begin[i:j] - begin[i]) // limit
            inner = [i, *(np.flatnonzero(part[1:] != part[:-1]) + 1 + i).tolist(), j]
            out += [(x, y, x > i) for x, y in zip(inner, inner[1:], strict=False)]
            a = j
    return [*out, (a, len(name), False)] if a < len(name) else out


def repeats(size: np.ndarray, data: bytes, place: np.ndarray, limit: int = PART_BYTES, name: np.ndarray | None = None) -> np.ndarray:
    """Marks the bytes of segments at which a repeat starts.

    size: bytes of each segment in data; place: a number for each segment's first byte by which starts are ordered; name:
    what equal strings have in common, by which the segments are sorted (None: any two may share strings).
    """
    text = np.frombuffer(data, np.uint8)
    first = np.cumsum(size) - size
    marks = np.zeros(len(text), bool)
    known = None  # classes of the parts of one name: fingerprints, earliest place, where that is, and its order
    for a, b, on in parts_of(size, np.zeros(len(size), np.int8) if name is None else name, limit):
        low, high = int(first[a]), int(first[b - 1] + size[b - 1])
        inner = np.arange(high - low) - np.repeat(first[a:b] - low, size[a:b])
        valid = inner + LENGTH <= np.repeat(size[a:b], size[a:b])
        where = np.repeat(place[a:b], size[a:b]) + inner
        at, group = classes(text[low:high], valid)
        order = np.lexsort((where[at], group))
        at, group = at[order], group[order]
        new = np.ones(len(at), bool)
        new[1:] = group[1:] != group[:-1]
        marks[at[~new] + low] = True
        at = at[new]
        # the parts of a name that is split are merged: binary search of each in the ones before it
        if not on:
            known = None
        if not len(at) or not (on or (b < len(size) and (name is None or name[b] == name[b - 1]))):
            continue
        f, g = fingerprints(text[low:high], at)
        order = np.lexsort((g, f))
        f, g, at = f[order], g[order], at[order]
        at, rank = at + low, where[at]
        if known is None:
            known = f, g, at, rank
            continue
        kf, kg, kat, krank = known
        hit = np.searchsorted(kf, f)
        same = np.zeros(len(f), bool)
        here = hit.copy()
        while True:  # equal first hashes stand side by side
            inside = here < len(kf)
            like = inside & (kf[np.minimum(here, len(kf) - 1)] == f)
            same |= (match := like & (kg[np.minimum(here, len(kf) - 1)] == g) & ~same)
            hit = np.where(match, here, hit)
            if not (like & ~same).any():
                break
            here = here + 1
        mine, theirs = at[same], kat[hit[same]]
        late = rank[same] > krank[hit[same]]
        marks[np.where(late, mine, theirs)] = True
        kat, krank = kat.copy(), krank.copy()
        kat[hit[same]] = np.where(late, theirs, mine)
        krank[hit[same]] = np.where(late, krank[hit[same]], rank[same])
        kf, kg, kat, krank = (np.concatenate([x, y[~same]]) for x, y in zip((kf, kg, kat, krank), (f, g, at, rank), strict=True))
        order = np.lexsort((kg, kf))
        known = kf[order], kg[order], kat[order], krank[order]
    return marks


def named_twice(segments: list[bytes], often: np.ndarray, limit: int = PART_BYTES) -> list[int]:
    """Numbers of the segments that have their name twice; about limit bytes are looked at at a time."""
    size = np.array([len(x) for x in segments], np.int64)
    part = (np.cumsum(size) - size) // limit
    bounds = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(size)]
    out = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        _, of, _, _, own = runs(np.frombuffer(b"".join(segments[a:b]), np.uint8), size[a:b], often)
        out += (np.unique(of[own]) + a).tolist()
    return out


def judge(blocks: int, often):
    def run(table: pa.Table) -> pa.Table:
        data = b"".join(table.column("bytes").to_pylist())
        rows = table.drop_columns(["bytes"]).to_pylist()
        name, uid, start, size = (column(rows, c, k) for c, k in (("name", "<u8"), ("uid", "<i8"), ("start", "<u4"), ("size", "<u4")))
        first = np.cumsum(size.astype(np.int64)) - size
        # equal segments of other blocks: the earliest stays, the others are repeats as they are
        seen: dict[bytes, int] = {}
        again = []
        for i in np.lexsort((start, uid)).tolist():
            if seen.setdefault(data[first[i] : first[i] + int(size[i])], i) != i:
                again.append(i)
        spans = [[uid[again]], [start[again].astype(np.int64)], [start[again].astype(np.int64) + size[again]]]
        # a name's only segment can repeat nothing but itself, and that only if it has its name twice
        keep = np.fromiter(seen.values(), np.int64, len(seen))
        _, of, n = np.unique(name[keep], return_inverse=True, return_counts=True)
        alone = n[of] == 1
        lone = keep[alone]
        own = named_twice([x for x, one in zip(seen, alone.tolist(), strict=True) if one], often.value)
        del seen
        order = np.concatenate([keep[~alone], lone[np.array(own, np.int64)]])
        order = order[np.argsort(name[order], kind="stable")]
        # starts in the order of (uid, place): documents are numbered, and lie farther apart than any is long
        number = np.unique(uid, return_inverse=True)[1].astype(np.int64)
        place = (number << 32) + start
        uid, start, size, name = uid[order], start[order].astype(np.int64), size[order].astype(np.int64), name[order]
        data = b"".join([data[a : a + n] for a, n in zip(first[order].tolist(), size.tolist(), strict=True)])
        marks = repeats(size, data, place[order], name=name)
        del data
        trim()
        edge = np.diff(np.concatenate([[0], marks.view(np.int8), [0]]))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # a segment's last bytes are never marked
        of = np.searchsorted(np.cumsum(size), a, side="right")
        offset = start[of] - (np.cumsum(size) - size)[of]
        spans[0] += [uid[of], column(rows, "rest_uid", "<i8")]
        spans[1] += [a + offset, column(rows, "rest_start", "<u4").astype(np.int64)]
        spans[2] += [b + offset + LENGTH - 1, column(rows, "rest_end", "<u4").astype(np.int64)]
        spans = [np.concatenate(x) for x in spans]
        out = [{"block": k, **c} for k, c in dealt(spans[0] % blocks, {"uid": spans[0], "start": spans[1].astype(np.uint32), "end": spans[2].astype(np.uint32)})]
        return pa.Table.from_batches([batch_of(out, SPANS)])

    return run


def union(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal covered runs of half-open spans."""
    order = np.argsort(start, kind="stable")
    out: list[tuple[int, int]] = []
    for a, b in zip(start[order].tolist(), end[order].tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def drop(kept: list[str], with_text: bool):
    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        rows = spans.to_pylist()
        uid, start, end = (column(rows, c, k) for c, k in (("uid", "<i8"), ("start", "<u4"), ("end", "<u4")))
        order = np.argsort(uid, kind="stable")
        uid, start, end = uid[order], start[order], end[order]
        mine = docs.column(UID).to_numpy()
        low, high = np.searchsorted(uid, mine), np.searchsorted(uid, mine, side="right")
        out = []
        for t, a, b in zip(docs.column("text").to_pylist(), low, high, strict=True):
            data = t.encode()
            gone = union(start[a:b], end[a:b])
            left = b"".join([data[x:y] for x, y in zip([0, *(g[1] for g in gone)], [*(g[0] for g in gone), len(data)], strict=True)])
            out.append((len(data), len(data) - len(left), len(gone), hashlib.sha256(left).hexdigest(), left.decode(errors="ignore") if with_text else None))
        arrays = [docs.column(c) for c in kept] + [pa.array([x[k] for x in out], t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.int64()), (3, pa.string()), *(((4, pa.string()),) if with_text else ()))]
        return pa.Table.from_arrays(arrays, names=[*kept, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(("kept_text",) if with_text else ())])

    return run


def prime(n: int) -> int:
    """The least prime from n on."""
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def numbered(docs: DataFrame, name: str = UID) -> DataFrame:
    """docs with a number of each row, ascending with doc_id: doc_id itself where no two rows share it, else new ones."""
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null or doc_id < 0").isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long"))
    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    return cut(docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()), "numbered")


def frequent(docs: DataFrame, total: int) -> np.ndarray:
    """Sorted hashes (below LOW) of strings that occur often in the corpus, by a sample of docs(__uid, text)."""
    share = min(1.0, max(SAMPLE_SHARE, SAMPLE_BYTES / max(total, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", limit=PART_BYTES):
            data = [t.encode() for t in batch.column("text").to_pylist()]
            text = np.frombuffer(b"".join(data), np.uint8)
            if len(text) < GRAM:
                continue
            gram = grams(text)
            size = np.array([len(x) for x in data], np.int64)
            inside = (np.arange(len(text)) + GRAM <= np.repeat(np.cumsum(size), size))[: len(gram)]
            name, n = np.unique(gram[inside & (gram < LOW)], return_counts=True)
            # what a slice has once adds little to what is frequent
            yield pa.RecordBatch.from_arrays([pa.array(name[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["name", "n"])

    drawn = F.pmod(F.xxhash64(UID, F.lit(6)), F.lit(1 << 30)) / float(1 << 30) < share
    counted = docs.where(drawn).select("text").mapInArrow(run, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= max(OFTEN_LEAST, OFTEN * share)).orderBy(F.desc("n"), "name").limit(MOST).select("name").toArrow()
    return np.sort(rows.column("name").to_numpy().astype(np.uint64))


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, kept_sha256 and kept_text beside its columns; clashing names are replaced."""
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")]
    docs = numbered(docs.select(kept).withColumn("text", F.coalesce("text", F.lit(""))))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    often = docs.sparkSession.sparkContext.broadcast(frequent(docs, total))
    blocks = prime(max(16, total // BLOCK_BYTES))
    blocked = docs.withColumn(BLOCK, F.pmod(UID, F.lit(blocks)).cast("int"))
    told = docs.select(UID, "text").mapInArrow(send_names(blocks, often), NAMES)
    wanted = told.groupBy("bucket").applyInArrow(repeated(blocks), WANTED)
    segments = blocked.groupBy(BLOCK).cogroup(wanted.groupBy("block")).applyInArrow(cut_out(blocks), SEGMENTS)
    spans = segments.groupBy("shard").applyInArrow(judge(blocks, often), SPANS)
    fields = T.StructType([*blocked.select(kept).schema.fields, *T.StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text)])
    return blocked.groupBy(BLOCK).cogroup(spans.groupBy("block")).applyInArrow(drop(kept, with_text), fields)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return remove_repeats(docs, with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
