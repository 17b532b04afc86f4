"""SentencePiece (BPE) encoding through a prefix table of last tokens, and decoding.

The merge rule joins, again and again, the adjacent pair of symbols whose joined
piece has the highest score, the leftmost of equals.  Of two adjacent tokens it
can be told alone whether the rule would ever join across their border, and a
sequence of tokens is the encoding of its text exactly if every adjacent pair is
compatible in that sense.  So every prefix of a text has one last token: the one
among the pieces ending there (found by an automaton over the vocabulary) that
is compatible with the last token of the prefix before it.  ``PieceEncoder``
fills that table from left to right and reads the ids off backwards; the work is
linear in the text.

The compatibility test replays the merges inside both tokens in the rule's order
and asks at each step whether the pair across the border would be next.  A
token's own merges are found once; a piece whose merges do not end in itself is
never a token.

Texts are cut first where no piece of the vocabulary spans the border: before a
run of spaces, and between characters of different families, where characters
that stand side by side in some piece are of one family.  These units are encoded
on their own, and each distinct one once while it stays in the cache.

Scale: one pass over the rows without a shuffle; memory is one Arrow batch, the
vocabulary and bounded caches.  The model file must lie at the same path on
every executor.

Defined cases: a null text counts as empty and has no ids; empty texts decode to
empty texts; repeated rows are encoded alike; an empty table gives no rows; all
input columns are kept and those named as the output are replaced.  Characters
outside the vocabulary become their bytes.  Models of another type than BPE with
byte fallback and identity normalisation are refused.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The sign that stands for a space inside pieces; a fixed value of the format.
SPACE = "▁"
#: Units in each of two generations of the cache, their length at most, and cached answers of the pair test.
CACHE_UNITS, UNIT_CHARS, CACHE_PAIRS = 300_000, 64, 1_000_000


@lru_cache(maxsize=2)
def processor(path: str):
    """The library's model: its pieces and its ``decode``."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


class PieceEncoder:
    """Ids of whole texts, equal to ``SentencePieceProcessor.encode(text)``."""

    def __init__(self, path: str):
        import ahocorasick

        self.lib = lib = processor(path)
        known = [i for i in range(len(lib)) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.ids = {lib.id_to_piece(i): i for i in known}
        self.byte_id = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        unusual = lib.encode("　éﬁ  x ")       # an identity rule leaves these as they are
        if (any(lib.is_unused(i) for i in known) or not all(map(lib.is_byte, self.byte_id))
                or lib.decode(unusual) != "　éﬁ  x " or self._unusual(path)):
            raise ValueError("only BPE models with byte fallback, identity normalisation and no user symbols")
        self.piece = {i: p for p, i in self.ids.items()}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.auto = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.auto.add_word(p, (i, len(p)))
        self.auto.make_automaton()
        spans_space = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.units = re.compile(".+" if spans_space else self._cutting(self.ids), re.DOTALL)
        self.tables: dict[int, list | None] = {}
        self.size = len(lib)
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _cutting(pieces) -> str:
        """Pattern of a run of spaces with the characters of one family behind it."""
        head: dict[str, str] = {}

        def family(c):
            while head.setdefault(c, c) != c:
                head[c] = c = head[head[c]]
            return c
        for p in pieces:
            p = p.lstrip(SPACE)
            for a, b in zip(p, p[1:]):
                head[family(a)] = family(b)
        families: dict[str, list[str]] = {}
        for c in head:
            families.setdefault(family(c), []).append(c)
        runs = ["[" + "".join(map(re.escape, sorted(f))) + "]+" for f in sorted(families.values(), key=len, reverse=True)]
        return f"{SPACE}*(?:{'|'.join(runs + [f'[^{SPACE}]'])})|{SPACE}+"

    @staticmethod
    def _unusual(path: str) -> bool:
        """Whether the model is not plain BPE, changes texts first, or holds user-defined pieces."""
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        return (spec.model_type != spec.BPE or norm.precompiled_charsmap != b"" or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces or spec.treat_whitespace_as_suffix
                or any(p.type == p.USER_DEFINED for p in model.pieces))

    def _edges(self, token: int):
        """Merges of a token in order: (score, first symbol after it, last symbol after it).

        The first entry has no score and the symbols before any merge; None if
        the merges do not end in the token itself.
        """
        found = self.tables.get(token, ())
        if found != ():
            return found
        parts = list(self.piece[token])
        steps = [(None, parts[0], parts[-1])]
        score = self.score.get
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))
        found = self.tables[token] = steps if len(parts) == 1 else None
        return found

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merge rule leaves the border between tokens ``a`` and ``b`` alone."""
        left, right = self._edges(a), self._edges(b)
        i = j = 0
        cross = self.score.get(left[0][2] + right[0][1])
        while True:
            la = left[i + 1][0] if i + 1 < len(left) else None
            lb = right[j + 1][0] if j + 1 < len(right) else None
            # of equal scores the leftmost is merged: inside a, then across, then inside b
            if la is not None and (cross is None or la >= cross) and (lb is None or la >= lb):
                i += 1
                if left[i][2] == left[i - 1][2]:
                    continue
            elif cross is not None and (lb is None or cross >= lb):
                return False
            elif lb is not None:
                j += 1
                if right[j][1] == right[j - 1][1]:
                    continue
            else:
                return True
            cross = self.score.get(left[i][2] + right[j][1])

    def _learnt(self, pair: int) -> bool:
        """Whether a token may follow another (or, as the number of pieces, no token), kept for later."""
        a, b = divmod(pair, self.size)
        found = self._edges(b) is not None and (a == self.size or self.compatible(a, b))
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[pair] = found
        return found

    def unit(self, text: str) -> list[int]:
        """Ids of a text without dummy prefix, spaces already replaced."""
        n, size = len(text), self.size
        last = [size] * (n + 1)         # last token of the prefix of that length; none at the start and behind a byte
        step = [1] * (n + 1)
        get, learn = self.pairs.get, self._learnt
        done = -1
        for end, (token, length) in self.auto.iter(text):
            if end != done:
                pair = last[end + 1 - length] * size + token
                fits = get(pair)
                if fits or fits is None and learn(pair):
                    done, end = end, end + 1
                    last[end], step[end] = token, length
        out: list[int] = []
        at = n
        while at > 0:
            if last[at] == size:
                out.extend(self.byte_id[b] for b in reversed(text[at - 1].encode()))
            else:
                out.append(last[at])
            at -= step[at]
        out.reverse()
        return out

    def raw(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        units = self.units.findall(SPACE + text.replace(" ", SPACE))
        known, older, long = self.known, self.older, {}
        for u in set(units).difference(known):
            ids = older.get(u)
            if ids is None:
                ids = array("i", self.unit(u)).tobytes()
            (known if len(u) <= UNIT_CHARS else long)[u] = ids
        if long:
            out = b"".join([known.get(u) or long[u] for u in units])
        else:
            out = b"".join(map(known.__getitem__, units))
        if len(known) > CACHE_UNITS:
            self.known, self.older = {}, known
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.raw(text), "<i4").tolist()


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _mapped(df: DataFrame, column: str, out: str, kind: T.DataType, work) -> DataFrame:
    """``df`` with ``out`` = ``work`` of each batch's ``column``; what was named ``out`` goes."""
    kept = [f for f in df.schema.fields if f.name.lower() != out.lower()]
    schema = T.StructType(kept + [T.StructField(out, kind)])
    names = [f.name for f in kept]
    place = [f.name.lower() for f in df.schema.fields].index(column.lower())
    keep = [k for k, f in enumerate(df.schema.fields) if f.name.lower() != out.lower()]

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(k) for k in keep] + [work(b.column(place))], names + [out])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text, an array of ints."""
    def work(column):
        enc = encoder(path)
        raw = [enc.raw(t.as_py() or "") for t in column]
        ends = np.cumsum([0, *(len(r) // 4 for r in raw)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4")))

    return _mapped(docs, text, out, T.ArrayType(T.IntegerType()), work)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text that each array of ids stands for; null ids: an empty text."""
    def work(column):
        text = processor(path).decode
        return pa.array([text(x.as_py() or []) for x in column], pa.string())

    return _mapped(docs, ids, out, T.StringType(), work)
