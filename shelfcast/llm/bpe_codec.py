"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece, exactly one of the tokens that end there can be the last token of its
encoding: the one that is compatible with the last token of the prefix before it. An automaton
of all tokens lists, in one pass, the tokens that are suffixes of each prefix; the pair test picks
the one that holds and stores it; back-pointers from the end give the ids.
"""

from array import array
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa

from shelfcast.llm.bpe_rules import read_tokenizer, rules_of
from shelfcast.llm.common import arrow_type, record_batch, ship, slices, texts
from shelfcast.llm.pieces import PieceValues

# Pieces a worker remembers, a bound of its memory (about 50 MB); results don't depend on it.
CACHE_PIECES = 200_000
# Arrays of a slice take some hundred bytes per byte of text.
SLICE_BYTES = 1 << 19


class PrefixEncoder:
    """Encodes texts to token ids and back under the rules of one vocabulary."""

    def __init__(self, rules):
        self.rules = rules
        self.automaton = ahocorasick.Automaton()
        for word, token in rules.whole.items():
            self.automaton.add_word(word.decode("latin-1"), (token, len(word)))
        self.automaton.make_automaton()
        self.pieces = PieceValues(self._packed, CACHE_PIECES)

    def encode_piece(self, piece):
        """Ids of one piece of bytes, in time linear in its length."""
        token = self.rules.whole.get(piece)
        if token is not None:
            return [token]
        compatible = self.rules.compatible
        last = [-1] * (len(piece) + 1)
        sizes = [0] * (len(piece) + 1)
        for end, (token, size) in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            start = end - size
            if last[end] < 0 and (start == 0 or compatible(last[start], token)):
                last[end], sizes[end] = token, size
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at -= sizes[at]
        return ids[::-1]

    def _packed(self, piece):
        return array("I", self.encode_piece(piece)).tobytes()

    def encode_many(self, many):
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts, owner, special = [], [], {}
        for k, text in enumerate(many):
            for is_special, part in self.rules.segments(text):
                if is_special:
                    special[len(parts)] = array("I", [self.rules.special[part]]).tobytes()
                    part = ""
                parts.append(part)
                owner.append(k)
        values, which, bounds = self.pieces.of(parts)
        in_order = np.array([*values, b""], object)[:-1][which].tolist()
        out = [[] for _ in many]
        for n, k in enumerate(owner):
            found = special.get(n)
            out[k].append(found or b"".join(in_order[bounds[n] : bounds[n + 1]]))
        return [b"".join(p) for p in out]

    def decode(self, packed):
        """Text of packed ids; bytes that aren't UTF-8 become replacement characters."""
        ids = np.frombuffer(packed, "<u4").tolist()
        table = self.rules.token_bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


_encoders = {}


def encoder_of(source):
    rules = rules_of(source)
    if _encoders.get("rules") is not rules:
        _encoders.update(rules=rules, encoder=PrefixEncoder(rules))
    return _encoders["encoder"]


def encode_documents(docs, tokenizer, key="doc_id", text="text"):
    """Token ids of every document: key, ids (array of int), in the rows' own order.

    A missing or empty text has no ids. Repeated rows stay; other columns are left behind. A row
    depends on its own text only, so a lost task is simply run again.
    """
    spark = docs.sparkSession
    ship(spark)
    source = spark.sparkContext.broadcast(read_tokenizer(tokenizer))
    ids = docs.select(key, text)
    schema = pa.schema([(key, arrow_type(ids, key)), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        encoder = encoder_of(source.value)
        for part in slices(batches, text, SLICE_BYTES):
            lists = [np.frombuffer(ids, "<i4") for ids in encoder.encode_many(texts(part, text))]
            yield record_batch(schema, **{key: part.column(key), "ids": lists})

    return ids.mapInArrow(run, f"{key} {ids.schema[key].dataType.simpleString()}, ids array<int>")


CODEC_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


def round_trip(docs, tokenizer):
    """Encode and decode every text: doc_id, n_tokens, and digests of the ids and decoded text.

    Null texts are empty: no ids, the digests of nothing. The order and number of rows are kept.
    """
    ship(docs.sparkSession)
    source = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))

    def run(batches):
        encoder = encoder_of(source.value)
        for part in slices(batches, limit=SLICE_BYTES):
            counts, ids, decoded = [], [], []
            for packed in encoder.encode_many(texts(part)):
                counts.append(len(packed) // 4)
                ids.append(sha256(packed).hexdigest())
                decoded.append(sha256(encoder.decode(packed).encode()).hexdigest())
            yield record_batch(
                CODEC_SCHEMA,
                doc_id=part.column("doc_id"),
                n_tokens=counts,
                ids_sha256=ids,
                decoded_sha256=decoded,
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
