"""Byte passages that repeat across documents, from enhanced suffix arrays of anchored contexts.

A passage of `length` bytes that occurs in two documents has the same smallest k-mer in both, so
only these anchors need to be compared. A first exchange finds the anchors that several
documents share. For these, the bytes around the anchor (all passages that contain it) go to
the anchor's bucket. Equal contexts become one twice, in their block of documents and in the bucket,
so a passage of many documents weighs one row per block, whatever their number. In the bucket the
suffixes of different contexts of an anchor form a suffix array with common-prefix lengths. A stack
scan gives its interval tree; an interval whose members are preceded by different bytes is a maximal
repeat group, and the smallest document among them is the one that keeps the passage. What a
context loses goes back to the blocks that sent it, where its occurrences are looked up by hash.
"""

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm.common import ship
from shelfcast.llm.pieces import mix

SLICE_BYTES = 1 << 20
# Members of repeat groups that are looked at together; a bound of memory.
STEP_ROWS = 1 << 19
# Contexts that are cut or unpacked together; a bound of memory.
STEP_CONTEXTS = 1 << 18
MOST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class RepeatParams:
    """Passage length and anchor length in bytes; text bytes per bucket and per block.

    The numbers of buckets and blocks follow the size of the texts, 64 at least.
    """

    length: int = 50
    anchor: int = 24
    bucket_bytes: int = 16 << 20
    block_bytes: int = 8 << 20

    @property
    def reach(self):
        """Bytes before an anchor that belong to passages containing it."""
        return self.length - self.anchor


def kmer_hashes(values, size):
    """Hash of every run of `size` bytes, built from runs of powers of two."""
    run = mix(values.astype(np.uint64) + np.uint64(1))
    power, factor, out, done = 1, np.array([0x9E3779B97F4A7C15], np.uint64), None, 0
    while power <= size:
        if size & power:
            if out is None:
                out = run
            else:
                keep = len(run) - done if done else len(run)
                out = out[: max(keep, 0)] * factor + run[done : done + max(keep, 0)]
                out = out[: len(values) - (done + power) + 1]
            done += power
        if power * 2 <= size:
            run = run[:-power] * factor + run[power:]
            factor = factor * factor
        power *= 2
    return mix(out)


def sliding(values, size, pick):
    """pick (minimum or maximum) over every window of `size` values."""
    width, out = 1, values
    while width * 2 <= size:
        out = pick(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(raw, params):
    """Anchors of many byte texts: number of the text, place in it, hash of the k-mer there.

    A place is an anchor if its k-mer has the smallest hash of some passage around it.
    """
    sizes = np.array([len(r) for r in raw], np.int64)
    starts = np.cumsum(sizes) - sizes
    values = np.frombuffer(b"".join(raw), np.uint8)
    window = params.length - params.anchor + 1
    if len(values) < params.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = kmer_hashes(values, params.anchor)
    # k-mers that leave their text can't be chosen; neither can windows reach out of a text.
    outside = np.zeros(len(values) + 1, np.int32)
    np.add.at(outside, np.maximum(starts + sizes - params.anchor + 1, starts), 1)
    np.add.at(outside, starts + sizes, -1)
    outside = np.cumsum(outside)[: len(hashes)] > 0
    hashes[outside] = np.uint64(2**64 - 1)
    least = sliding(hashes, window, np.minimum)
    padded = np.zeros(len(hashes) + window - 1, np.uint64)
    padded[window - 1 : window - 1 + len(least)] = least
    chosen = np.flatnonzero((sliding(padded, window, np.maximum) == hashes) & ~outside)
    owner = np.searchsorted(starts, chosen, "right") - 1
    # Texts without bytes share their start with the next one.
    inside = sizes[owner] >= params.length
    chosen, owner = chosen[inside], owner[inside]
    return owner, chosen - starts[owner], hashes[chosen]


_CODEC = pa.Codec("zstd")


def _pressed(values):
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def _packed(keys, columns, names):
    """A table with one row per key: the columns' values of that key as compressed bytes."""
    order = np.argsort(keys, kind="stable")
    distinct, first = np.unique(keys[order], return_index=True)
    ends = np.append(first[1:], len(order))
    arrays = [pa.array(distinct.astype(np.int64))]
    for column in columns:
        ordered = np.ascontiguousarray(column[order])
        arrays.append(pa.array([_pressed(ordered[s:e]) for s, e in zip(first, ends)], pa.binary()))
    return pa.table(arrays, names=names)


def _unpacked(table, name, dtype):
    parts = [
        _CODEC.decompress(p[8:], int.from_bytes(p[:8], "little"), asbytes=True)
        for p in table.column(name).to_pylist()
    ]
    return np.frombuffer(b"".join(parts), dtype)


def _raw_sizes(table, name):
    """Number of bytes of each packed value."""
    return np.array([int.from_bytes(p[:8], "little") for p in table.column(name).to_pylist()], np.int64)


SHORT = np.uint64(0xFFFFFFFFFFFF)


def _shared_anchors(placed, params, buckets):
    """Per block of documents: anchors (48 bits) that another document has, too.

    A block sends each of its anchors once, with a mark if several of its documents have it. Documents
    of different blocks differ, so an anchor of two blocks is shared, too.
    """

    def emit(key, table):
        ids, raw = _usable(table)
        parts = []
        for rows, owner, _, hashes in _anchored(raw, params):
            parts.append((hashes, ids[rows[owner]]))
        if not parts:
            parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        hashes, ids = (np.concatenate(c) for c in zip(*parts))
        hashes, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        marks = np.zeros(len(hashes), np.uint8)
        marks[which[ids != ids[first][which]]] = 1
        short = (hashes >> np.uint64(16)) & SHORT
        planes = [((short >> np.uint64(s)) & np.uint64(0xFFFF)).astype("<u2") for s in (0, 16, 32)]
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        sent = _packed(bucket, [*planes, marks], ["bucket", "h0", "h1", "h2", "marks"])
        return sent.append_column("block", pa.array([key[0].as_py()] * len(sent), pa.int64()))

    def match(table):
        marks, sizes = _unpacked(table, "marks", np.uint8), _raw_sizes(table, "marks")
        block = np.repeat(table.column("block").to_numpy().astype(np.int64), sizes)
        h = [_unpacked(table, f"h{k}", "<u2").astype(np.uint64) for k in range(3)]
        short = h[0] | h[1] << np.uint64(16) | h[2] << np.uint64(32)
        order = np.argsort(short, kind="stable")
        short, block, marks = short[order], block[order], marks[order]
        first = np.flatnonzero(np.append(True, short[1:] != short[:-1])) if len(short) else []
        if not len(first):
            return _packed(block, [short], ["block", "found"])
        size = np.diff(np.append(first, len(short)))
        several = np.repeat((size > 1) | (np.maximum.reduceat(marks, first) > 0), size)
        return _packed(block[several], [short[several]], ["block", "found"])

    sent = placed.groupBy("_block").applyInArrow(
        emit, "bucket long, h0 binary, h1 binary, h2 binary, marks binary, block long"
    )
    return sent.groupBy("bucket").applyInArrow(match, "block long, found binary")


def _block_of(ids, blocks):
    """Block of a document; the same as the expression in repeated_spans()."""
    return np.mod(ids.astype(np.int64), blocks)


def _prime(least):
    """The smallest prime from `least` on, so that ids with a common step fill all blocks."""
    while any(least % d == 0 for d in range(2, int(least**0.5) + 1)):
        least += 1
    return least


def _usable(table):
    """Ids (-1 where null) and bytes of all rows; rows without an id have no bytes."""
    ids = table.column("doc_id")
    known = ids.is_valid().to_pylist()
    raw = [(t or "").encode() if k else b"" for t, k in zip(table.column("text").to_pylist(), known)]
    return np.array([-1 if i is None else i for i in ids.to_pylist()], np.int64), raw


def _anchored(raw, params):
    """anchors() of many texts, about SLICE_BYTES at a time, and the numbers of these texts."""
    k = 0
    while k < len(raw):
        begin, total = k, 0
        while k < len(raw) and (k == begin or total + len(raw[k]) <= SLICE_BYTES):
            total += len(raw[k])
            k += 1
        yield np.arange(begin, k), *anchors(raw[begin:k], params)


def _contexts(raw, wanted, params):
    """Occurrences of wanted anchors (48 bits, sorted): text, place, hash, context, its sizes.

    A context holds the bytes of all passages around an anchor, so many before and from it on;
    bytes beyond the text are zero.
    """
    reach, width = params.reach, params.reach + params.length
    columns = np.arange(width)[None]
    for rows, owner, place, hashes in _anchored(raw, params) if len(wanted) else ():
        short = (hashes >> np.uint64(16)) & SHORT
        at = np.minimum(np.searchsorted(wanted, short), len(wanted) - 1)
        here = wanted[at] == short
        owner, place, hashes = owner[here], place[here], hashes[here]
        sizes = np.array([len(raw[r]) for r in rows], np.int64)
        before = np.minimum(place, reach)
        after = np.minimum(sizes[owner] - place, params.length)
        flat = np.frombuffer(b"".join([bytes(reach), *(raw[r] for r in rows), bytes(width)]), np.uint8)
        around = np.lib.stride_tricks.sliding_window_view(flat, width)
        starts = (np.cumsum(sizes) - sizes)[owner] + place
        # Steps bound the memory of the contexts of a text full of wanted anchors.
        for k in range(0, len(owner), STEP_CONTEXTS):
            part = slice(k, k + STEP_CONTEXTS)
            context = around[starts[part]]
            edge = np.flatnonzero((before[part] < reach) | (after[part] < params.length))
            low, high = reach - before[part][edge], reach + after[part][edge]
            context[edge] *= (columns >= low[:, None]) & (columns < high[:, None])
            yield rows[owner[part]], place[part], hashes[part], context, before[part], after[part]


def _context_hashes(context, before, after):
    sizes = before.astype(np.uint64) << np.uint64(32) | after.astype(np.uint64)
    return mix(_row_hashes(context) ^ mix(sizes))


def _distinct(parts):
    """Rows of the first of equal keys; parts are tuples of arrays, the keys first."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    _, first, which = np.unique(columns[0], return_index=True, return_inverse=True)
    return [c[first] for c in columns], which


def _merged(parts):
    """Equal contexts as one, with their smallest and largest id (the last two columns)."""
    least, largest = (np.concatenate([p[c] for p in parts]) for c in (-2, -1))
    columns, which = _distinct([p[:-2] for p in parts])
    low, high = np.full(len(columns[0]), MOST), np.full(len(columns[0]), -MOST - 1)
    np.minimum.at(low, which, least)
    np.maximum.at(high, which, largest)
    return (*columns, low, high)


def _sent_contexts(placed, shared, params, buckets):
    """Per bucket of anchors: the distinct contexts of each block, with smallest and largest id."""
    width = params.reach + params.length

    def cut(texts, found):
        ids, raw = _usable(texts)
        wanted = np.unique(_unpacked(found, "found", "<u8"))
        none = np.zeros(0, np.int64)
        parts = [(none.astype(np.uint64), none, np.zeros((0, width), np.uint8), none, none, none, none)]
        fresh = 0
        for rows, _, hashes, context, before, after in _contexts(raw, wanted, params):
            mine = ids[rows]
            key = _context_hashes(context, before, after)
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            part = (key, bucket, context, before, after, mine, mine)
            # Contexts shorter than a passage hold none.
            long = before + after >= params.length
            parts.append(tuple(c[long] for c in part))
            fresh += len(part[0])
            if fresh > STEP_CONTEXTS:
                parts, fresh = [_merged(parts)], 0
        _, bucket, context, before, after, least, largest = _merged(parts)
        return _packed(
            bucket,
            [context, before.astype("<u2"), after.astype("<u2"), least.astype("<i8"), largest.astype("<i8")],
            ["bucket", "context", "before", "after", "least", "largest"],
        )

    kind = "bucket long, context binary, before binary, after binary, least binary, largest binary"
    return placed.groupBy("_block").cogroup(shared.groupBy("block")).applyInArrow(cut, kind)


def _row_hashes(rows):
    """64-bit hash of every row of bytes."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    for column in padded.view(np.uint64).T:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def interval_tree(lengths, least):
    """Intervals (first, last, length) of common-prefix lengths of at least `least`.

    lengths[i] is what entries i - 1 and i of a suffix array have in common. A stack scan closes an
    interval where the common length falls; each interval holds all entries that share it.
    """
    out, stack = [], []
    places = np.flatnonzero(lengths >= least)
    values = lengths[places].tolist()
    last = None
    for i, length in zip(places.tolist(), values):
        if last is not None and i != last + 1:
            while stack:
                begin, value = stack.pop()
                out.append((begin, last, value))
        begin = i - 1
        while stack and stack[-1][1] > length:
            begin, value = stack.pop()
            out.append((begin, i - 1, value))
        if not stack or stack[-1][1] < length:
            stack.append((begin, length))
        last = i
    while stack:
        begin, value = stack.pop()
        out.append((begin, last, value))
    return out


def _over_ranges(pick, values, first, last):
    """pick (minimum or maximum) of values[first:last + 1] for many ranges."""
    edges = np.stack([first, last + 1], axis=1).ravel()
    return pick.reduceat(np.append(values, values[:1]), edges)[::2]


def maximal_repeats(contexts, before, after, groups, params):
    """Maximal repeats among different contexts of equal anchors.

    Yields, per column: the column, the contexts in suffix order, and the repeat groups as arrays
    first, last and length; contexts[order[first : last + 1]] all have the group's string there. An
    interval preceded by the same byte throughout is part of a longer repeat and left out.
    """
    reach, width = params.reach, contexts.shape[1]
    low, high = reach - before.astype(np.int64), reach + after.astype(np.int64)
    found, number = [], 0
    # Suffixes from the anchor on are sorted once; one byte further left, equal bytes keep the order.
    right = np.zeros((len(contexts), -(-(width - reach) // 8) * 8), np.uint8)
    right[:, : width - reach] = contexts[:, reach:]
    # Where one context ends and others go on with zero bytes, the shorter one comes first.
    order = np.lexsort([high, *right.view(">u8").T[::-1], groups])
    for column in range(reach, -1, -1):
        if column < reach:
            key = groups * 256 + contexts[:, column]
            order = order[np.argsort(key[order], kind="stable")]
        rows = order[((low <= column) & (high >= column + params.length))[order]]
        if len(rows) < 2:
            continue
        same = groups[rows[1:]] == groups[rows[:-1]]
        for ahead in (0, params.length // 2, params.length - 1):
            same &= contexts[rows[1:], column + ahead] == contexts[rows[:-1], column + ahead]
        near = np.flatnonzero(same) + 1
        differ = contexts[rows[near], column:] != contexts[rows[near - 1], column:]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width - column)
        limit = np.minimum(high[rows[near]], high[rows[near - 1]]) - column
        common = np.zeros(len(rows), np.int64)
        common[near] = np.minimum(shared, limit)
        intervals = interval_tree(common, params.length)
        if not intervals:
            continue
        first, last, length = np.array(intervals, np.int64).T
        if column:
            ahead = np.where(low[rows] < column, contexts[rows, column - 1].astype(np.int16), -1)
            lowest, highest = (_over_ranges(p, ahead, first, last) for p in (np.minimum, np.maximum))
            diverse = (lowest < 0) | (lowest != highest)
            first, last, length = first[diverse], last[diverse], length[diverse]
        if len(first):
            yield column, rows, first, last, length


def repeated_columns(contexts, before, after, groups, smallest, params):
    """Runs of columns (context, start, end) that a context of a smaller document has, too."""
    depth = np.zeros((len(contexts), contexts.shape[1] + 2), np.int16)
    for column, rows, first, last, length in maximal_repeats(
        contexts, before, after, groups, params
    ):
        mine = smallest[rows]
        owner = _over_ranges(np.minimum, mine, first, last)
        best = np.zeros(len(rows), np.int64)
        sizes = last - first + 1
        part = (np.cumsum(sizes) - sizes) // STEP_ROWS
        for chosen in np.split(np.arange(len(first)), np.flatnonzero(np.diff(part)) + 1):
            steps = sizes[chosen]
            members = np.repeat(first[chosen] - (np.cumsum(steps) - steps), steps)
            members += np.arange(len(members))
            lost = mine[members] > np.repeat(owner[chosen], steps)
            np.maximum.at(best, members[lost], np.repeat(length[chosen], steps)[lost])
        hit = np.flatnonzero(best)
        depth[rows[hit], column + 1] += 1
        depth[rows[hit], column + 1 + best[hit]] -= 1
    covered = (np.cumsum(depth, axis=1, dtype=np.int16) > 0).astype(np.int8)
    change = np.diff(covered, axis=1)
    (row, start), (_, end) = np.nonzero(change == 1), np.nonzero(change == -1)
    return row, start, end


def _answers(contexts, params, blocks):
    """Per block of documents: what its contexts lose, told by hash of the context.

    Where `ends` is -1, documents after `owners` lose the whole context. Otherwise the document
    `owners`, the first one with this context, loses its bytes from `starts` to `ends`.
    """
    reach, width = params.reach, params.reach + params.length
    names = ["block", "shorts", "keys", "owners", "starts", "ends"]

    def search(table):
        seen, pairs = [], []
        # Every block sends a context once; only the first of all blocks is kept.
        sizes = _raw_sizes(table, "context")
        step = (np.cumsum(sizes) - sizes) // (STEP_CONTEXTS * width)
        for rows in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(step)) + 1):
            part = table.take(pa.array(rows))
            context = _unpacked(part, "context", np.uint8).reshape(-1, width)
            before, after = _unpacked(part, "before", "<u2"), _unpacked(part, "after", "<u2")
            key = _context_hashes(context, before, after)
            pairs.append((key, _unpacked(part, "least", "<i8"), _unpacked(part, "largest", "<i8")))
            seen.append(_distinct([(key, context, before, after)])[0])
        (distinct, context, before, after), _ = _distinct(seen)
        keys, least, largest = (np.concatenate(c) for c in zip(*pairs))
        which = np.searchsorted(distinct, keys)
        smallest = np.full(len(distinct), MOST)
        np.minimum.at(smallest, which, least)
        anchored = np.ascontiguousarray(context[:, reach : reach + params.anchor])
        # Blocks with a document after the first one lose the whole context there.
        later = np.flatnonzero(largest > smallest[which])
        out = [(_block_of(least[later], blocks), which[later], np.full(len(later), -1), np.full(len(later), -1))]
        # The first document of a context loses what an even smaller one has.
        _, group, size = np.unique(_row_hashes(anchored), return_inverse=True, return_counts=True)
        several = np.flatnonzero(size[group] > 1)
        member, start, end = repeated_columns(
            context[several], before[several], after[several], group[several], smallest[several], params
        )
        member = several[member]
        out.append((_block_of(smallest[member], blocks), member, start, end))
        block, place, starts, ends = (np.concatenate(c) for c in zip(*out))
        told, back = np.unique(place, return_inverse=True)
        hashes = kmer_hashes(anchored[told].ravel(), params.anchor)[:: params.anchor] if len(told) else told
        shorts = (hashes.astype(np.uint64) >> np.uint64(16)) & SHORT
        columns = [shorts[back], distinct[place], smallest[place], starts.astype("<i2"), ends.astype("<i2")]
        return _packed(block, columns, names)

    kind = "block long, shorts binary, keys binary, owners binary, starts binary, ends binary"
    return contexts.groupBy("bucket").applyInArrow(search, kind)


def _spans(ids, raw, found, params):
    """Rows of a block with the bytes they lose: row, start, end; found are answers of the block."""
    keys, owners = _unpacked(found, "keys", "<u8"), _unpacked(found, "owners", "<i8")
    starts, ends = _unpacked(found, "starts", "<i2"), _unpacked(found, "ends", "<i2")
    order = np.argsort(keys, kind="stable")
    keys, owners, starts, ends = (c[order] for c in (keys, owners, starts, ends))
    none = np.zeros(0, np.int64)
    out = [(none, none, none)]
    wanted = np.unique(_unpacked(found, "shorts", "<u8"))
    for rows, place, _, context, before, after in _contexts(raw, wanted, params):
        key = _context_hashes(context, before, after)
        begin = np.searchsorted(keys, key, "left")
        steps = np.searchsorted(keys, key, "right") - begin
        answer = np.repeat(begin - (np.cumsum(steps) - steps), steps) + np.arange(steps.sum())
        rows, place, before, after = (np.repeat(c, steps) for c in (rows, place, before, after))
        whole = ends[answer] < 0
        lost = np.where(whole, ids[rows] > owners[answer], ids[rows] == owners[answer])
        start = np.where(whole, place - before, place - params.reach + starts[answer])
        end = np.where(whole, place + after, place - params.reach + ends[answer])
        out.append((rows[lost], start[lost], end[lost]))
    return [np.concatenate(c) for c in zip(*out)]


def _union(starts, ends, size):
    """Disjoint sorted spans that cover the same bytes; neighbours that touch are one."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    covered = np.concatenate([[0], (np.cumsum(depth[:-1]) > 0).astype(np.int8), [0]])
    change = np.diff(covered)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def repeated_spans(docs, finish, fields, params=RepeatParams()):
    """Rows made by finish(table, raw, spans) from the documents of a block.

    `table` holds the block's rows with all columns of `docs`; `spans` lists, per row, the starts and
    ends of the bytes to remove: those covered by a passage of params.length bytes that also starts
    in a document with a smaller doc_id. Rows with the same doc_id are one document: they never
    remove from each other. Rows without doc_id, and null or short texts, lose nothing.
    """
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, blocks = max(64, size // params.bucket_bytes), _prime(max(64, size // params.block_bytes))
    columns = docs.columns

    # All three uses of the documents read one exchange.
    place = F.coalesce("doc_id", F.xxhash64("text"), F.lit(0))
    placed = docs.withColumn("_block", F.pmod(place, F.lit(blocks)))
    shared = _shared_anchors(placed, params, buckets)
    answers = _answers(_sent_contexts(placed, shared, params, buckets), params, blocks)

    def last(table, found):
        ids, raw = _usable(table)
        rows, starts, ends = _spans(ids, raw, found, params)
        order = np.argsort(rows, kind="stable")
        rows, starts, ends = rows[order], starts[order], ends[order]
        edges = np.searchsorted(rows, np.arange(len(raw) + 1))
        lists = [
            _union(starts[a:b], ends[a:b], len(text)) if b > a else ((), ())
            for text, a, b in zip(raw, edges[:-1], edges[1:])
        ]
        raw = [(t or "").encode() for t in table.column("text").to_pylist()]
        return finish(table.select(columns), raw, lists)

    return placed.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(last, fields)


def _kept(raw, starts, ends):
    if not len(starts):
        return raw
    edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(raw)]
    return b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2])])


def repeat_digest(docs, params=RepeatParams()):
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of `docs`."""

    def finish(table, raw, spans):
        removed = [int(np.sum(e) - np.sum(s)) if len(s) else 0 for s, e in spans]
        hashes = [sha256(_kept(r, *s)).hexdigest() for r, s in zip(raw, spans)]
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_bytes": pa.array([len(r) for r in raw], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array([len(s) for s, _ in spans], pa.int64()),
                "kept_sha256": hashes,
            }
        )

    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeated_spans(docs.select("doc_id", "text"), finish, fields, params)


def drop_repeats(docs, params=RepeatParams()):
    """The rows and columns of `docs`, their texts without the repeated passages.

    A character that is cut in the middle goes with its passage. Null texts stay null. A column
    n_chars is brought up to date.
    """

    def finish(table, raw, spans):
        texts = [
            None if t is None else _kept(r, *s).decode("utf-8", "ignore")
            for t, r, s in zip(table.column("text").to_pylist(), raw, spans)
        ]
        at = table.schema.get_field_index("text")
        return table.set_column(at, "text", pa.array(texts, table.schema.field("text").type))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    cleaned = repeated_spans(docs, finish, fields, params)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)
    return cleaned
