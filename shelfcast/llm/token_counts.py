"""Token counts from a compiled finite-state transducer, without building token ids.

A state of the transducer holds, for every token that may still be under way, its place in the
token tree, the last token before it and its count against the best encoding so far. Reading one
byte moves to the next state and emits the change of the token count; the first byte of a piece is
read from the start state. States and transitions are compiled when first met and shared by all
texts.

Every text is read in chunks of about CHUNK_BYTES bytes, all chunks of a batch at once. The map of a
chunk is a table from entry state to (exit state, tokens). A chunk that starts a piece has one row,
which holds for any entry. A chunk cut inside a piece, where a run without a border is longer than a
chunk, has a row for each state in which the chunk before it can end. A parallel prefix scan composes
the maps; token counts are differences of the scanned ones.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from shelfcast.llm.bpe_rules import read_tokenizer, rules_of
from shelfcast.llm.common import record_batch, ship, slices, texts
from shelfcast.llm.pieces import code_points, cut, flat_spans, mix

# States of a worker; beyond them, between two batches, compiled parts are dropped.
MAX_STATES = 120_000
CHUNK_BYTES = 128
# Characters of a batch; a longer text goes on in the next one.
BATCH_CHARS = 1 << 20
SLICE_BYTES = 1 << 20
# Characters around a window that decide where its pieces start, with some to spare.
CONTEXT = 8
# Entry of a map that does not depend on the state before it.
ANY = -1


class MoveTable:
    """Transitions by key (state * 256 + byte), looked up for many keys at once."""

    def __init__(self, size=1 << 14):
        self.keys = np.full(size, -1, np.int64)
        self.target = np.zeros(size, np.int64)
        self.emitted = np.zeros(size, np.int64)
        self.used = 0

    def places(self, wanted):
        """Where each key is, or the free place where it belongs."""
        last = len(self.keys) - 1
        at = (mix(wanted.view(np.uint64)) & np.uint64(last)).view(np.int64)
        held = self.keys[at]
        left = np.flatnonzero((held != wanted) & (held >= 0))
        while len(left):
            at[left] = (at[left] + 1) & last
            held = self.keys[at[left]]
            left = left[(held != wanted[left]) & (held >= 0)]
        return at

    def add(self, keys, target, emitted):
        """Add transitions whose keys are distinct and new."""
        while 2 * (self.used + len(keys)) > len(self.keys):
            full = np.flatnonzero(self.keys >= 0)
            held = self.keys[full], self.target[full], self.emitted[full]
            self.__init__(2 * len(self.keys))
            self.add(*held)
        self.used += len(keys)
        columns = keys, target, emitted
        while len(columns[0]):  # of the keys that want one place, one gets it in each round
            taken, first = np.unique(self.places(columns[0]), return_index=True)
            for mine, values in zip((self.keys, self.target, self.emitted), columns):
                mine[taken] = values[first]
            columns = [np.delete(values, first) for values in columns]


class CountTransducer:
    """Counts tokens by walking compiled transitions; state 0 is the start of a piece."""

    def __init__(self, rules, max_states=MAX_STATES):
        self.rules, self.max_states = rules, max_states
        self.children, self.token_at = [{}], [-1]
        for word, token in rules.whole.items():
            node = 0
            for byte in word:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = self.children[node][byte]
            self.token_at[node] = token
        self.restart()

    def restart(self):
        start = ((0, -1, 0),)
        self.number, self.states, self.moves = {start: 0}, [start], MoveTable()

    def state_number(self, state):
        """Number of a state, a new one if it has none."""
        found = self.number.setdefault(state, len(self.states))
        if found == len(self.states):
            self.states.append(state)
        return found

    def make_room(self, state):
        """Drop what is compiled if it is too much; the number of `state` afterwards."""
        if len(self.states) <= self.max_states:
            return state
        kept = self.states[state]
        self.restart()
        return self.state_number(kept)

    def compile(self, state, byte):
        """Next state and emitted count of one transition."""
        alive, emitted, last = [], None, None
        for node, before, behind in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.token_at[child]
            if (
                token >= 0
                and last is None
                and (before < 0 or self.rules.compatible(before, token))
            ):
                last, emitted = token, behind + 1
            if self.children[child]:
                alive.append((child, before, behind))
        target = tuple((n, b, c - emitted) for n, b, c in alive) + ((0, last, 0),)
        return self.state_number(target), emitted

    def step(self, states, symbols):
        """Next states and emitted counts, one byte each."""
        keys = states * 256 + symbols
        at = self.moves.places(keys)
        new = keys[self.moves.keys[at] != keys]
        if len(new):
            new = np.unique(new)
            moves = [self.compile(key >> 8, key & 255) for key in new.tolist()]
            self.moves.add(new, *np.array(moves, np.int64).T)
            at = self.moves.places(keys)
        return self.moves.target[at], self.moves.emitted[at]


@dataclass(frozen=True)
class ChunkMaps:
    """Maps of chunks 0, 1, ... as rows (chunk, entry state, exit state, tokens), sorted."""

    chunk: np.ndarray
    entry: np.ndarray
    exit: np.ndarray
    tokens: np.ndarray

    @staticmethod
    def _keys(chunk, entry):
        return (chunk << 32) + entry + 1

    @classmethod
    def of(cls, *columns):
        order = np.argsort(cls._keys(columns[0], columns[1]), kind="stable")
        return cls(*(c[order] for c in columns))

    def columns(self):
        return self.chunk, self.entry, self.exit, self.tokens

    def rows(self, chunk, state):
        """The row of each chunk's map that holds for a state; -1 where there is none."""
        keys = self._keys(self.chunk, self.entry)
        found = np.full(len(chunk), -1, np.int64)
        for entry in (state, np.full_like(state, ANY)):
            wanted = self._keys(chunk, entry)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found = np.where((found < 0) & (keys[at] == wanted), at, found)
        return found

    def then(self, after):
        """Maps that read a chunk of these and then the chunk of `after` with the same number."""
        at = after.rows(self.chunk, self.exit)
        return ChunkMaps(self.chunk, self.entry, after.exit[at], self.tokens + after.tokens[at])

    def scan(self, count):
        """Map k of the result reads the chunks 0 to k; as many rounds as `count` has bits."""
        found, step = self, 1
        while step < count:
            ahead = found.chunk < count - step
            earlier = ChunkMaps(
                found.chunk[ahead] + step, *(c[ahead] for c in found.columns()[1:])
            )
            done = found.chunk < step
            found = ChunkMaps(
                *(
                    np.concatenate([c[done], d])
                    for c, d in zip(found.columns(), earlier.then(found).columns())
                )
            )
            step *= 2
        return found


@dataclass(frozen=True)
class Symbols:
    """Bytes of a batch, the places that start a piece, and where each window begins and ends."""

    values: np.ndarray
    starts: np.ndarray
    windows: np.ndarray

    @classmethod
    def read(cls, windows):
        """Of windows (text with context, begin, end of the window in it)."""
        points, at = code_points([text for text, _, _ in windows])
        begins = np.zeros(len(points), bool)
        begins[cut(points)[0]] = True
        low, high = np.array([(a, b) for _, a, b in windows]).T
        flat, bounds = flat_spans(at + low, at + high)
        inside = points[flat]
        sizes = 1 + (inside >= 0x80) + (inside >= 0x800) + (inside >= 0x10000)
        offsets = np.append(0, np.cumsum(sizes))
        raw = "".join(text[a:b] for text, a, b in windows).encode()
        values = np.frombuffer(raw, np.uint8).astype(np.int64)
        return cls(values, offsets[:-1][begins[flat]], offsets[bounds])

    def chunks(self, size):
        """Borders of chunks: the last start of a piece before each multiple of `size`, or that
        multiple itself where no piece starts within `size` bytes; and the windows' borders."""
        grid = np.arange(0, len(self.values), size)
        before = np.searchsorted(self.starts, grid, "right") - 1
        start = np.append(self.starts, -size)[before]
        borders = np.where(start > grid - size, start, grid)
        return np.unique(np.concatenate([borders, self.windows]))


class TokenCounter:
    """Counts of many texts under one vocabulary."""

    def __init__(self, rules, chunk=CHUNK_BYTES, batch=BATCH_CHARS, max_states=MAX_STATES):
        self.rules, self.chunk, self.batch = rules, chunk, batch
        self.transducer = CountTransducer(rules, max_states)

    def walk(self, symbols, begins, ends, states):
        """Exit states and tokens of chunks read from the given states, all in step."""
        fresh = np.zeros(len(symbols.values) + 1, bool)
        fresh[symbols.starts] = True
        order = np.argsort(begins - ends, kind="stable")
        at, sizes = begins[order], (ends - begins)[order]
        state, total = states[order], np.zeros(len(order), np.int64)
        active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")
        for step, n in enumerate(active.tolist()):
            place = at[:n] + step
            entered = np.where(fresh[place], 0, state[:n])
            state[:n], emitted = self.transducer.step(entered, symbols.values[place])
            total[:n] += emitted
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def maps(self, symbols, borders, state):
        """Maps of all chunks; `state` is the one in front of the first chunk.

        A chunk inside a piece starts with a row for the start state. Rows for the exits of the
        chunk before it are added until none is missing: at most as often as there are states in which
        a border can be reached, twice as a rule, since walks from different states soon meet.
        """
        begins, ends = borders[:-1], borders[1:]
        chunk = np.arange(len(begins))
        free = np.isin(begins, symbols.starts)
        entry = np.where(free, ANY, 0)
        if not free[0]:
            entry[0] = state
        new = ChunkMaps(
            chunk, entry, *self.walk(symbols, begins, ends, np.maximum(entry, 0))
        )
        found = new
        while True:
            follows = new.chunk < len(begins) - 1
            after, states = new.chunk[follows] + 1, new.exit[follows]
            missing = found.rows(after, states) < 0
            pairs = np.unique(np.stack([after[missing], states[missing]]), axis=1)
            if not pairs.shape[1]:
                return found
            after, states = pairs
            walked = self.walk(symbols, begins[after], ends[after], states)
            new = ChunkMaps(after, states, *walked)
            merged = zip(found.columns(), new.columns())
            found = ChunkMaps.of(*(np.concatenate(pair) for pair in merged))

    def window_counts(self, windows, state):
        """Tokens that end in each window of a batch, and the state after the last one."""
        state = self.transducer.make_room(state)
        symbols = Symbols.read(windows)
        borders = symbols.chunks(self.chunk)
        scanned = self.maps(symbols, borders, state).scan(len(borders) - 1)
        sums = np.append(0, scanned.tokens)[np.searchsorted(borders, symbols.windows)]
        return np.diff(sums).tolist(), int(scanned.exit[-1])

    def _batches(self, parts):
        """Lists of (owner, window); parts beyond a batch go on in the next one."""
        held, room = [], self.batch
        for owner, text in parts:
            at = 0
            while at < len(text):
                end = min(len(text), at + room)
                first = max(0, at - CONTEXT)
                held.append((owner, (text[first : end + CONTEXT], at - first, end - first)))
                room -= end - at
                at = end
                if not room:
                    yield held
                    held, room = [], self.batch
        if held:
            yield held

    def counts(self, many):
        """Token counts of texts; special strings count as one token each."""
        out, parts = [0] * len(many), []
        for k, text in enumerate(many):
            for special, part in self.rules.segments(text):
                if special:
                    out[k] += 1
                else:
                    parts.append((k, part))
        state = 0
        for batch in self._batches(parts):
            found, state = self.window_counts([window for _, window in batch], state)
            for (owner, _), n in zip(batch, found):
                out[owner] += n
        return out


_counters = {}


def counter_of(source):
    rules = rules_of(source)
    if _counters.get("rules") is not rules:
        _counters.update(rules=rules, counter=TokenCounter(rules))
    return _counters["counter"]


COUNT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())]
)


def count_tokens(docs, tokenizer):
    """doc_id, n_bytes and n_tokens of every row; null and empty texts have none.

    Rows are independent: repeated rows stay, doc_id may be null, other columns are ignored.
    """
    ship(docs.sparkSession)
    source = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))

    def run(batches):
        counter = counter_of(source.value)
        for part in slices(batches, limit=SLICE_BYTES):
            many = texts(part)
            yield record_batch(
                COUNT_SCHEMA,
                doc_id=part.column("doc_id"),
                n_bytes=[len(t.encode()) for t in many],
                n_tokens=counter.counts(many),
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long"
    )
