"""Byte-level BPE encoding and decoding: speculate and verify.

A text is cut at the special tokens and then by the split pattern.  For every
distinct piece, greedy longest match over the vocabulary proposes tokens.  A
proposal is the BPE result exactly if every adjacent pair of its tokens is
compatible, that is if merging their joined bytes never crosses the boundary.
All pairs of many pieces are tested together with numpy.  Only pieces with an
incompatible pair are merged exactly.

Why a pair decides: merges run in rank order, so the symbol at the right edge of
token ``a`` climbs the right spine of its merge tree, and the one at the left edge
of ``b`` the left spine.  The boundary is crossed exactly if two of these symbols
that exist at the same time form a merge that comes before the left one is used
up (strictly: on equal rank the left merge goes first) and not after the right one
is.  The model checks when it loads that a merge always ranks after the merges
that made its parts, and speculates only with tokens that encode to themselves.

Defined cases: null text counts as empty and gives no tokens; a special token's
string inside a text gives its id, as the library does; bytes that are no valid
UTF-8 after decoding become U+FFFD; an id outside the vocabulary decodes to
nothing.  Extra columns pass through; the new columns are renamed if taken.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, small_batches

#: Fixed value: the split pattern that belongs to this family of vocabularies, in terms of three classes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: Fixed value: Unicode's white space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CACHE = 200_000     # pieces that a worker remembers
SHORT = 64          # bytes up to which pieces are merged many at a time
CHUNK = 1 << 20     # characters of text handled together
NEVER = np.int32(2**31 - 1)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such vocabulary files: printable ones for themselves, the rest from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def split_pattern() -> str:
    """SPLIT with the letters and numbers of the Unicode version that the tokenizers library was built with.

    Characters that this Python knows are the same there.  Of later ones, which
    the regex library may know, the tokenizers library is asked itself.
    """
    from tokenizers import pre_tokenizers

    library = pre_tokenizers.ByteLevel(add_prefix_space=False)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    sets = {}
    for name, sample in (("L", "a"), ("N", "1")):
        late = [c for c in regex.findall(rf"\p{{{name}}}", every) if unicodedata.category(c) == "Cn"]
        gone = [ord(c) for c in late if len(library.pre_tokenize_str(sample + c)) > 1]
        runs: list[list[int]] = []
        for c in gone:
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        minus = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)
        sets[name] = rf"\p{{{name}}}--[{minus}]" if runs else rf"\p{{{name}}}"
    other = f"[^[{WHITE}][{sets['L']}][{sets['N']}]]"
    return "(?V1)" + SPLIT.replace("[^{S}{L}{N}]", other).replace("{S}", WHITE) \
        .replace("{L}", sets["L"]).replace("{N}", sets["N"])


def latin_pattern() -> str:
    """SPLIT for texts of characters below U+0250, whose classes no Unicode version changes; for the faster ``re``."""
    def runs(kind: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)
    return SPLIT.replace("{L}", runs("L")).replace("{N}", runs("N")).replace("{S}", r"\t-\r \x85\xa0")


@dataclass
class Model:
    """A vocabulary and its merges as arrays; about 10 MB for 50,000 tokens, so it may be broadcast."""

    token: list[bytes]               # bytes of each id
    special: dict[str, int]
    merged: dict[tuple[int, int], tuple[int, int]]  # pair of ids -> rank, new id
    pair_key: np.ndarray             # sorted left * size + right
    pair_rank: np.ndarray
    left: np.ndarray                 # parts of each id, -1 for single bytes
    right: np.ndarray
    made: np.ndarray                 # id that the merge of each rank makes
    rank: np.ndarray                 # rank of the merge that makes the id, -1 for single bytes
    propose: dict[bytes, int]        # tokens that encode to themselves
    longest: dict[int, int]          # longest such token by first byte
    split: str                       # regular expression that cuts texts into pieces
    single: list[int]                # id of each byte
    shared: Encoder | None = None

    @staticmethod
    def load(path: str) -> Model:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *special.values()])
        token = [b""] * size
        for name, i in vocab.items():
            token[i] = bytes(letters[c] for c in name)
        for name, i in special.items():
            token[i] = name.encode()
        merged: dict[tuple[int, int], tuple[int, int]] = {}
        left, right, rank = (np.full(size, -1, np.int32) for _ in range(3))
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            merged[x, y] = (r, z)
            if rank[z] < 0:
                left[z], right[z], rank[z] = x, y, r
            if r <= max(rank[x], rank[y]):
                raise ValueError("a merge ranks before the merges that make its parts")
        key = np.fromiter((a * size + b for a, b in merged), np.int64, len(merged))
        order = np.argsort(key)
        ranks = np.fromiter((r for r, _ in merged.values()), np.int32, len(merged))
        of_byte = {token[i][0]: i for i in vocab.values() if len(token[i]) == 1}
        made = np.zeros(len(spec["model"]["merges"]), np.int64)
        for r, z in merged.values():
            made[r] = z
        model = Model(token, special, merged, key[order], ranks[order], left, right, made, rank, {}, {},
                      split_pattern(), [of_byte[b] for b in range(256)])
        for i in vocab.values():
            if model.merge(token[i]) == [i]:
                model.propose[token[i]] = i
                first = token[i][0]
                model.longest[first] = max(model.longest.get(first, 1), len(token[i]))
        return model

    # -- exact merging ------------------------------------------------------
    def merge(self, piece: bytes) -> list[int]:
        """BPE of one piece: lowest rank first, leftmost first among equals, by a heap over a linked list."""
        ids = [self.single[b] for b in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(hit[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (hit := self.merged.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.merged[a, b][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if hit := self.merged.get((ids[i], ids[k])):
                    heapq.heappush(heap, (hit[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (hit := self.merged.get((ids[h], ids[i]))):
                heapq.heappush(heap, (hit[0], h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """BPE of many short pieces: every round does the next merge of each piece that has one."""
        of_byte = np.array(self.single, np.int64)
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), n)
        done_ids, done_piece = [], []
        rank = np.full(len(ids), NEVER)
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inner] = self.pair_ranks(ids[inner], ids[inner + 1])
        while len(ids):
            start = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            size = np.diff(np.r_[start, len(ids)])
            low = np.minimum.reduceat(rank, start)
            live = np.repeat(low < NEVER, size)
            done_ids.append(ids[~live])
            done_piece.append(piece[~live])
            if not live.any():
                break
            at = np.flatnonzero(live & (rank == np.repeat(low, size)))
            at = at[np.r_[True, piece[at][1:] != piece[at][:-1]]]           # the leftmost of each piece
            ids[at] = self.made[rank[at]]
            keep = live.copy()
            keep[at + 1] = False
            place = np.cumsum(keep)[at] - 1                                 # of the new symbols
            ids, piece, rank = ids[keep], piece[keep], rank[keep]
            for left in (place, place[place > 0] - 1):                      # their pairs with both neighbours
                right = np.minimum(left + 1, len(ids) - 1)
                same = (right > left) & (piece[left] == piece[right])
                rank[left] = np.where(same, self.pair_ranks(ids[left], ids[right]), NEVER)
        ids, piece = np.concatenate(done_ids), np.concatenate(done_piece)
        ids = ids[np.argsort(piece, kind="stable")]
        ends = np.cumsum(np.bincount(piece, minlength=len(pieces)))[:-1]
        return [x.tolist() for x in np.split(ids, ends)]

    # -- speculation and verification ---------------------------------------
    def longest_match(self, piece: bytes) -> list[int]:
        out, i, n, propose, longest = [], 0, len(piece), self.propose, self.longest
        while i < n:
            for j in range(min(n, i + longest[piece[i]]), i, -1):
                if (t := propose.get(piece[i:j])) is not None:
                    out.append(t)
                    i = j
                    break
        return out

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * len(self.token) + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether merging their joined bytes leaves the boundary alone.

        Walks down both spines at once, from the tokens to the bytes at the
        boundary: of the two symbols, the one made later is opened next.
        """
        good = np.ones(len(a), bool)
        at, x, y = np.arange(len(a)), a.astype(np.int32), b.astype(np.int32)
        x_end, y_end = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(at):
            r = self.pair_ranks(x, y)
            bad = (r < x_end) & (r <= y_end) & (r < NEVER)
            good[at[bad]] = False
            born_x, born_y = self.rank[x], self.rank[y]
            go = ~bad & ((born_x >= 0) | (born_y >= 0))
            at, x, y, x_end, y_end, born_x, born_y = (v[go] for v in (at, x, y, x_end, y_end, born_x, born_y))
            # of equal ranks the left merge ran first, so the right symbol is opened first
            open_y = born_y >= born_x
            x, x_end = np.where(open_y, x, self.right[x]), np.where(open_y, x_end, born_x)
            y, y_end = np.where(open_y, self.left[y], y), np.where(open_y, born_y, y_end)
        return good

    def encode_pieces(self, pieces: list[bytes]) -> tuple[list[list[int]], int]:
        """Token ids of each piece, and how many pieces needed exact merging."""
        out = [self.longest_match(p) for p in pieces]
        n = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter(chain.from_iterable(out), np.int64, int(n.sum()))
        if len(flat) < 2:
            return out, 0
        inner = np.ones(len(flat), bool)
        inner[np.cumsum(n)[n > 0] - 1] = False          # the last token of a piece has no right neighbour
        at = np.flatnonzero(inner)
        pairs, back = np.unique(flat[at] * len(self.token) + flat[at + 1], return_inverse=True)
        good = self.compatible(pairs // len(self.token), pairs % len(self.token))[back]
        failed = np.unique(np.repeat(np.arange(len(out)), n)[at[~good]])
        short = [k for k in failed.tolist() if len(pieces[k]) <= SHORT]
        for k, ids in zip(short, self.merge_many([pieces[k] for k in short]) if short else [], strict=True):
            out[k] = ids
        for k in failed.tolist():
            if len(pieces[k]) > SHORT:
                out[k] = self.merge(pieces[k])
        return out, len(failed)

    def encoder(self) -> Encoder:
        """One encoder for each copy of the model, so that the tasks of a worker share what it remembers."""
        if self.shared is None:
            self.shared = Encoder(self)
        return self.shared

    def decode(self, ids: list[int]) -> str:
        return decoded(self.token, ids)


def decoded(token: list[bytes], ids: list[int]) -> str:
    return b"".join([token[i] for i in ids if 0 <= i < len(token)]).decode("utf-8", "replace")


class Encoder:
    """Encodes whole texts with one model; remembers the pieces of the last one or two times ``CACHE``."""

    def __init__(self, model: Model):
        self.model, self.known, self.before = model, {}, {}
        self.split, self.latin = regex.compile(model.split), re.compile(latin_pattern())
        self.beyond = re.compile("[^\x00-\u024f]")
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(model.special, key=len, reverse=True))) + ")") \
            if model.special else None

    def pieces(self, text: str) -> list[str]:
        return (self.split if self.beyond.search(text) else self.latin).findall(text)

    def parts(self, text: str) -> list[str | int]:
        """Pieces of the text; a special token as its id."""
        if self.special is None or not any(s in text for s in self.model.special):
            return self.pieces(text)
        out: list[str | int] = []
        for k, x in enumerate(self.special.split(text)):
            out.extend([self.model.special[x]] if k % 2 else self.pieces(x))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.parts(t) for t in texts]
        if len(self.known) > CACHE:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        new = []
        for p in set().union(*parts).difference(known):
            if isinstance(p, int):
                known[p] = np.int32(p).tobytes()
            elif (ids := before.get(p)) is not None:
                known[p] = ids
            else:
                new.append(p)
        ids, _ = self.model.encode_pieces([p.encode() for p in new])
        ends = np.cumsum([0, *map(len, ids)]) * 4
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]) // 4).tobytes()
        ends = ends.tolist()
        known.update(zip(new, [flat[i:j] for i, j in zip(ends, ends[1:], strict=False)], strict=True))
        find = known.__getitem__
        return [np.frombuffer(b"".join(map(find, x)), np.int32) for x in parts]


def _groups(texts: list[str | None]) -> list[list[str]]:
    """Texts in runs of about CHUNK characters."""
    out: list[list[str]] = [[]]
    size = 0
    for t in texts:
        if size > CHUNK:
            out.append([])
            size = 0
        out[-1].append(t or "")
        size += len(t or "")
    return out


def _ids(encoder: Encoder, batch: pa.Array) -> pa.ListArray:
    """The token ids of a batch of texts."""
    parts = []
    for k in range(0, len(batch), 512):
        for group in _groups(batch.slice(k, 512).to_pylist()):
            parts.extend(encoder.encode(group))
    sizes = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))


def _texts(token: list[bytes], batch: pa.ListArray) -> pa.StringArray:
    """The texts that a batch of token ids stands for."""
    out = []
    for k in range(0, len(batch), 256):
        part = batch.slice(k, 256)
        ends = np.cumsum(np.r_[0, pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)]).tolist()
        ids = part.flatten().to_numpy(zero_copy_only=False)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(token)):
            out.extend(decoded(token, x or []) for x in part.to_pylist())
            continue
        parts = list(map(token.__getitem__, ids.tolist()))
        out.extend(b"".join(parts[i:j]).decode("utf-8", "replace") for i, j in zip(ends, ends[1:], strict=False))
    return pa.array(out, pa.string())


@dataclass
class Encoding:
    """An encoding that waits for ``decode``, so that one Python worker of a task does both."""

    df: DataFrame
    model: Model
    text_col: str
    out_col: str


def encode(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "ids", together: bool = False) -> DataFrame | Encoding:
    """``df`` with the token ids of the whole text (array of int); ``together``: left to the ``decode`` that follows."""
    if together:
        return Encoding(df, model, text_col, out_col)
    held = small_batches(df).sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<int>")
    def ids(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = held.value.encoder()
        for batch in it:
            yield _ids(encoder, batch)

    return df.withColumn(fresh(df, out_col)[0], ids(F.col(text_col)))


def decode(df: DataFrame | Encoding, model: Model, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for, special tokens included.

    For an ``Encoding``: with its ids and their text.  A task then runs one Python worker that holds both, not
    two at a time, of which each may come to hold an encoder with all that it remembers.
    """
    if isinstance(df, Encoding):
        return _round_trip(df, model, out_col)
    held = small_batches(df).sparkSession.sparkContext.broadcast(model.token)

    @F.arrow_udf("string")
    def text(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in it:
            yield _texts(held.value, batch)

    return df.withColumn(fresh(df, out_col)[0], text(F.col(ids_col)))


def _round_trip(coding: Encoding, model: Model, out_col: str) -> DataFrame:
    df = coding.df
    ids_name, text_name, both = fresh(df, coding.out_col, out_col, "_both")
    held = small_batches(df).sparkSession.sparkContext.broadcast(coding.model)
    token = None if model is coding.model else df.sparkSession.sparkContext.broadcast(model.token)

    @F.arrow_udf("struct<ids: array<int>, text: string>")
    def ids_and_text(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, back = held.value.encoder(), held.value.token if token is None else token.value
        for batch in it:
            ids = _ids(encoder, batch)
            yield pa.StructArray.from_arrays([ids, _texts(back, ids)], ["ids", "text"])

    return df.withColumn(both, ids_and_text(F.col(coding.text_col))) \
        .select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"{both}.ids").alias(ids_name), F.col(f"{both}.text").alias(text_name))
