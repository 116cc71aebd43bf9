"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece (one match of the split pattern) exactly one token can end a valid encoding of that
prefix.  The encoder stores that last token per prefix.  Reading the table from its end gives the whole encoding;
appending bytes only extends the table; an edit keeps the table up to the edit.  A token ``t`` may end the prefix of
length ``i`` when the last token of the prefix ``i - len(t)`` and ``t`` are *compatible*: merging by rank never crosses
the border between them.  Compatibility is decided by undoing merges on both sides of the border, latest first.

Many texts are encoded together: words and pieces are told apart with Arrow, each distinct piece is encoded once, all
prefix tables side by side with numpy, and the ids of the texts are put together by index.

Rows: null and empty texts give no tokens (the digests of empty bytes); very long texts and pieces are encoded whole, a
text at a time; repeated rows are encoded each; there are no ties, as every prefix has one last token; an empty table
gives no rows; extra columns are not looked at, and of clashing names the new columns win.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from weakref import WeakKeyDictionary

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from strandline.llm._tables import give_back, ship_package

#: Compatible and incompatible pairs that an encoder of single pieces remembers.
PAIR_MEMORY = 100_000
#: Bits of the slots that tell most pairs of tokens that stand for no third one.
PAIR_BITS = 21
#: Bytes of text that a task encodes at once (or one text).
SLICE_BYTES = 2_000_000
#: Pieces whose prefix tables are filled side by side, and their longest; longer ones are encoded one by one.
PIECES_BESIDE = 1 << 15
LONGEST_BESIDE = 48
#: Ids that are written out for a digest at once.
IDS_AT_ONCE = 1 << 21
#: Words that a pattern behind ``space_led`` takes as one piece, or as the letters and the marks behind them.
LETTERS = "^[A-Za-z]+$"
LETTERS_AND_MARKS = "^(?P<letters>[A-Za-z]+)(?P<marks>[.,;:!?]+)$"
#: A space that other white space or the end follows.
SPACE_BESIDE_SPACE = re.compile(r" (?:\s|\Z)")


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class PrefixEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = dict(zip(ranks.values(), ranks))
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.lasting: dict[bytes, int] = {}  # tokens that merging by rank can end with
        for raw, rank in ranks.items():
            if len(raw) == 1:
                self.lasting[raw] = rank
            elif halves := self._halves(raw, rank):
                self.left[rank], self.right[rank] = halves
                self.lasting[raw] = rank
        self.longest = max(map(len, self.lasting))
        self.endings = ahocorasick.Automaton()  # finds every token that ends at a byte; bytes are read as Latin-1
        for raw, rank in self.lasting.items():
            self.endings.add_word(raw.decode("latin-1"), (rank, len(raw)))
        self.endings.make_automaton()
        self._pairs: dict[int, bool] = {}

    def _halves(self, raw: bytes, below: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``raw``, by merging with earlier ranks only."""
        parts = [raw[k : k + 1] for k in range(len(raw))]
        while len(parts) > 2:
            best, at = below, -1
            for k in range(len(parts) - 1):
                rank = self.ranks.get(parts[k] + parts[k + 1], below)
                if rank < best:
                    best, at = rank, k
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether token ``b`` can follow token ``a`` with no merge across their border."""
        pair = a << 24 | b
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= PAIR_MEMORY:
                self._pairs.clear()
            known = self._pairs[pair] = self._border_holds(a, b)
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        token, ranks, left, right = self.token, self.ranks, self.left, self.right
        before = float("inf")  # a merge across the border of a lower rank would have come first
        while True:
            across = ranks.get(token[a] + token[b])
            if across is not None and across < before:
                return False
            if a in right and (a > b or b not in left):
                before, a = a, right[a]
            elif b in left:
                before, b = b + 1, left[b]  # of equal ranks the leftmost merges first, here the one across
            else:
                return True

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Fill ``last`` (last[i]: the last token of piece[:i]; last[0] unused) up to the whole piece, in place."""
        pairs, compatible = self._pairs, self.compatible
        begin, done = max(0, len(last) - self.longest), len(last) - 1
        for at, (rank, length) in self.endings.iter(piece.decode("latin-1"), begin):
            if at < done:
                continue  # this prefix has its token
            start = at + 1 - length
            if start:
                holds = pairs.get(last[start] << 24 | rank)
                if not (compatible(last[start], rank) if holds is None else holds):
                    continue
            last.append(rank)
            done = at + 1
        if len(last) <= len(piece):
            raise ValueError("a prefix has no last token: the vocabulary lacks single bytes")
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The token ids that a prefix table stands for."""
        ids, at = [], len(last) - 1
        while at > 0:
            ids.append(last[at])
            at -= len(self.token[last[at]])
        return ids[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)  # a piece that is a token needs no merging
        return [whole] if whole is not None else self.walk(self.extend(piece, [-1]))

    def decode(self, ids) -> bytes:
        token = self.token
        return b"".join([token[k] for k in ids])


class EncodedText:
    """A text with its pieces and prefix tables, for exact appends and edits.

    A change re-reads from three pieces before it (a match of the split pattern looks at most two pieces ahead) and
    stops where a new piece border meets an old one behind the change.  In the piece that holds the change, the prefix
    table is kept up to the first changed byte.
    """

    def __init__(self, encoder: PrefixEncoder, pattern: str, text: str = ""):
        self.encoder, self.pattern = encoder, regex.compile(pattern)
        self.text, self.pieces = "", []  # pieces: (start, end, prefix table)
        self.re_encoded = 0  # bytes that the last change had to encode
        self.replace(0, 0, text)

    @property
    def ids(self) -> list[int]:
        out: list[int] = []
        for start, end, last in self.pieces:
            whole = self.encoder.ranks.get(self.text[start:end].encode())
            out += [whole] if whole is not None else self.encoder.walk(last)
        return out

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        old, shift = self.pieces, len(new) - (end - start)
        first = next((k for k, p in enumerate(old) if p[1] >= start), len(old))
        first = max(0, first - 3)
        at = old[first][0] if first < len(old) else (old[-1][1] if old else 0)
        tables = {p[0]: p for p in old[first:] if p[0] <= start}
        borders = {p[0] + shift: k for k, p in enumerate(old) if p[0] >= end}
        text = self.text[:start] + new + self.text[end:]
        kept, self.re_encoded, rest = old[:first], 0, []
        for match in self.pattern.finditer(text, at):
            if match.start() in borders and match.start() >= start + len(new):
                rest = [(a + shift, b + shift, last) for a, b, last in old[borders[match.start()] :]]
                break
            raw, last = match.group().encode(), [-1]
            if before := tables.get(match.start()):
                same = min(start, before[1], match.end()) - match.start()
                last = before[2][: len(text[match.start() : match.start() + same].encode()) + 1]
            self.re_encoded += len(raw) + 1 - len(last)
            kept.append((match.start(), match.end(), self.encoder.extend(raw, last)))
        self.text, self.pieces = text, kept + rest


class PieceTables:
    """An encoder's tables as arrays: prefix tables of many pieces are filled side by side, one prefix after the other.

    ``arcs`` is the tree of the vocabulary's bytes (four words of 64 bits for each inner node: the bytes that lead on from
    it), ``firsts`` where the children of each word begin among ``children``, ``ends`` the token that ends at a node,
    ``splits`` every pair of tokens that stand for a third one when written together.
    """

    def __init__(self, encoder: PrefixEncoder):
        self.encoder = encoder
        size = max(encoder.token) + 1
        self.length = np.zeros(size, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        pairs, merged = [], []
        for raw, rank in encoder.ranks.items():
            self.length[rank] = len(raw)
            for k in range(1, len(raw)):
                a, b = encoder.ranks.get(raw[:k]), encoder.ranks.get(raw[k:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(rank)
        for side, known in ((self.left, encoder.left), (self.right, encoder.right)):
            side[list(known)] = list(known.values())
        order = np.argsort(np.array(pairs, np.int64))
        self.splits, self.merged = np.array(pairs, np.int64)[order], np.array(merged, np.int64)[order]
        self.taken = np.zeros(1 << PAIR_BITS, bool)  # most pairs are no split, and most of these find their slot free
        self.taken[self._slot(self.splits)] = True
        self._grow(encoder)

    @staticmethod
    def _slot(pairs: np.ndarray) -> np.ndarray:
        return (pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)

    def _grow(self, encoder: PrefixEncoder) -> None:
        inner = {b"": 0}  # inner nodes first, so that only they need a row
        for raw in encoder.ranks:
            for k in range(1, len(raw)):
                inner.setdefault(raw[:k], len(inner))
        self.inner = len(inner)
        leaves = {raw: self.inner + k for k, raw in enumerate(raw for raw in encoder.ranks if raw not in inner)}
        self.ends = np.full(self.inner + len(leaves), -1, np.int32)
        self.whole = self.ends.copy()
        keys, children = np.zeros(len(self.ends) - 1, np.int64), np.zeros(len(self.ends) - 1, np.int32)
        for raw, node in (*inner.items(), *leaves.items()):
            if raw:
                keys[node - 1], children[node - 1] = inner[raw[:-1]] << 8 | raw[-1], node
            self.whole[node] = encoder.ranks.get(raw, -1)
            self.ends[node] = encoder.lasting.get(raw, -1)
        order = np.argsort(keys)
        self.children, words = children[order], keys[order] >> 6
        self.arcs = np.zeros(4 * self.inner, np.uint64)
        np.bitwise_or.at(self.arcs, words, np.uint64(1) << (keys[order] & 63).astype(np.uint64))
        self.firsts = np.searchsorted(words, np.arange(4 * self.inner)).astype(np.int32)

    def led_on(self, node: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the inner nodes have a child for their letter (a byte), and these children."""
        word, bit = 4 * node + (letters >> 6), (letters & 63).astype(np.uint64)
        arcs = self.arcs[word]
        there = np.flatnonzero(arcs >> bit & np.uint64(1))
        below = (np.uint64(1) << bit[there]) - np.uint64(1)
        return there, self.children[self.firsts[word[there]] + np.bitwise_count(arcs[there] & below)]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`PrefixEncoder.compatible` of many pairs."""
        never = np.iinfo(np.int64).max
        holds = np.ones(len(a), bool)
        at, before = np.arange(len(a)), np.full(len(a), never)
        while len(at):
            pair = a << 32 | b
            near = np.flatnonzero(self.taken[self._slot(pair)])
            place = np.minimum(np.searchsorted(self.splits, pair[near]), len(self.splits) - 1)
            crossed = np.zeros(len(pair), bool)
            crossed[near] = (self.splits[place] == pair[near]) & (self.merged[place] < before[near])
            holds[at[crossed]] = False
            undo_a = (self.right[a] >= 0) & ((a > b) | (self.left[b] < 0))
            undo_b = ~undo_a & (self.left[b] >= 0)
            go = np.flatnonzero(~crossed & (undo_a | undo_b))
            at, a, b, undo_a = at[go], a[go], b[go], undo_a[go]
            before = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return holds

    def encode(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one line, and the number of ids, of the pieces that begin at ``begins`` in ``data``."""
        by_size = np.argsort(-sizes, kind="stable")
        counts = np.zeros(len(sizes), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # piece, place from its end, token
        n_long = int((sizes > LONGEST_BESIDE).sum())
        for piece in by_size[:n_long]:
            raw = data[begins[piece] : begins[piece] + sizes[piece]].tobytes()
            ids = np.array(self.encoder.encode_piece(raw)[::-1])
            found.append((np.full(len(ids), piece), np.arange(len(ids)), ids))
            counts[piece] = len(ids)
        for start in range(n_long, len(sizes), PIECES_BESIDE):
            chosen = by_size[start : start + PIECES_BESIDE]
            for step, at, ids in self._walked(data, begins[chosen], sizes[chosen]):
                found.append((chosen[at], np.full(len(at), step), ids))
                counts[chosen[at]] += 1
        ends = np.cumsum(counts)
        line = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for piece, step, ids in found:
            line[ends[piece] - 1 - step] = ids
        return line, counts

    def _walked(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Prefix tables of pieces sorted by falling size, read from their ends: (place, pieces, tokens)."""
        most = int(sizes[0]) if len(sizes) else 0
        letters = data[np.minimum(begins[None, :] + np.arange(most)[:, None], max(len(data) - 1, 0))]
        reaching = [int(np.searchsorted(-sizes, -e, side="right")) for e in range(most + 1)]  # pieces of e bytes or more
        last = np.full((most + 1, len(sizes)), -1, np.int32)
        for start in range(most):
            at, node = np.arange(reaching[start + 1]), np.zeros(reaching[start + 1], np.int32)
            for end in range(start + 1, most + 1):
                if len(at) and at[-1] >= reaching[end]:
                    near = at < reaching[end]
                    at, node = at[near], node[near]
                there, node = self.led_on(node, letters[end - 1, at])
                at = at[there]
                if not len(at):
                    break
                token = self.ends[node]
                if start:
                    new = np.flatnonzero((token >= 0) & (last[end, at] < 0))
                    piece, token = at[new], token[new]
                    holds = self.compatible(last[start, piece].astype(np.int64), token.astype(np.int64))
                    last[end, piece[holds]] = token[holds]
                else:
                    whole = np.where(sizes[at] == end, self.whole[node], -1)  # a piece that is a token needs no merging
                    last[end, at] = np.where(whole >= 0, whole, token)
                inner = np.flatnonzero(node < self.inner)
                at, node = at[inner], node[inner]
        left, at, step = sizes.copy(), np.flatnonzero(sizes), 0
        while len(at):
            token = last[left[at], at]
            if (token < 0).any():
                raise ValueError("a prefix has no last token: the vocabulary lacks single bytes")
            yield step, at, token
            left[at] -= self.length[token]
            at, step = at[left[at] > 0], step + 1


def spread(begins: np.ndarray, counts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The places of all items of runs ``which``, one run after the other."""
    n = counts[which]
    return np.repeat(begins[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class TextCoder:
    """Whole texts to ids and back, many at once: every distinct piece among them is encoded once.

    ``space_led``: the pattern always starts a piece at a single space between two other characters, as patterns with
    `` ?`` before their classes do, and takes ASCII letters as one piece and ``.,;:!?`` behind them as another.  Texts
    without other white space next to a space are then read word by word.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, space_led: bool = False):
        self.encoder, self.pattern, self.space_led = PrefixEncoder(ranks), regex.compile(pattern), space_led
        self.tables = PieceTables(self.encoder)
        names = range(len(self.tables.length))
        self.decimal = pa.array([b"%d " % k for k in names], pa.binary())
        self.bytes = pa.array([self.encoder.token.get(k, b"") for k in names], pa.binary())

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text], pa.string()))[0].tolist()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) in one line, and where each text begins in it (one more: the end)."""
        strings = [x or "" for x in texts.to_pylist()]
        by_word = [self.space_led and not SPACE_BESIDE_SPACE.search(x) for x in strings]
        none = pa.array([], pa.string())
        split = pc.split_pattern(pa.array([x for x, word in zip(strings, by_word) if word], pa.string()), " ")
        words, edges = split.flatten().dictionary_encode(), split.offsets.to_numpy().astype(np.int64)
        firsts = (words.dictionary.take(words.indices.take(pa.array(edges[:-1]))) if len(edges) > 1 else none).dictionary_encode()
        pieces = [self.pattern.findall(x) if not word else [] for x, word in zip(strings, by_word)]
        others = pa.array([p for each in pieces for p in each], pa.string()).dictionary_encode()
        # units: words behind a space, words that begin a text, pieces; each has a run of ids
        line, begins, counts = self._units(words.dictionary, firsts.dictionary, others.dictionary)
        n_words, n_firsts = len(words.dictionary), len(firsts.dictionary)
        units = words.indices.to_numpy().astype(np.int64)
        units[edges[:-1]] = firsts.indices.to_numpy() + n_words
        sizes = np.zeros(len(strings), np.int64)
        word_rows, piece_rows = np.flatnonzero(by_word), np.flatnonzero(~np.array(by_word, bool))
        sizes[word_rows] = np.diff(edges)
        sizes[piece_rows] = [len(pieces[k]) for k in piece_rows]
        if len(piece_rows):
            whole = np.empty(int(sizes.sum()), np.int64)
            of_word = np.repeat(np.isin(np.arange(len(strings)), word_rows), sizes)
            whole[of_word], whole[~of_word] = units, others.indices.to_numpy() + n_words + n_firsts
            units = whole
        ends = np.concatenate([[0], np.cumsum(counts[units])])
        return line[spread(begins, counts, units)], ends[np.concatenate([[0], np.cumsum(sizes)])]

    def _units(self, words: pa.Array, firsts: pa.Array, others: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in one line, and begins and counts of each unit's run."""
        n = [len(words), len(firsts), len(others)]
        sources, n_pieces, parts = [], np.ones(sum(n), np.int64), []  # the unit of each piece, pieces of each unit, pieces
        for array, lead, base in ((words, " ", 0), (firsts, "", n[0])):
            kind = pc.match_substring_regex(array, LETTERS).to_numpy(zero_copy_only=False).astype(np.int8)
            kind[pc.match_substring_regex(array, LETTERS_AND_MARKS).to_numpy(zero_copy_only=False)] = 2
            alone, marked, rest = (np.flatnonzero(kind == k) for k in (1, 2, 0))
            n_pieces[base + marked] = 2
            ended = pc.extract_regex(array.take(pa.array(marked)), LETTERS_AND_MARKS)
            found = [self.pattern.findall(lead + w) for w in array.take(pa.array(rest)).to_pylist()]
            n_pieces[base + rest] = [len(x) for x in found]
            for part in (array.take(pa.array(alone)), ended.field("letters")):
                parts.append(pc.binary_join_element_wise(lead, part, ""))
            parts += [ended.field("marks"), pa.array([p for x in found for p in x], pa.string())]
            sources += [base + alone, base + marked, base + marked, base + np.repeat(rest, n_pieces[base + rest])]
        distinct = pa.chunked_array([*parts, others], pa.string()).combine_chunks().dictionary_encode()
        numbers = distinct.indices.to_numpy().astype(np.int64)
        sources = np.concatenate([*sources, np.arange(n[0] + n[1], sum(n))])
        numbers = numbers[np.argsort(sources, kind="stable")]  # pieces by unit
        edges = np.frombuffer(distinct.dictionary.buffers()[1], np.int32)[: len(distinct.dictionary) + 1].astype(np.int64) if len(distinct.dictionary) else np.zeros(1, np.int64)
        buffer = distinct.dictionary.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        ids, of_piece = self.tables.encode(data, edges[:-1], np.diff(edges))
        line = ids[spread(np.cumsum(of_piece) - of_piece, of_piece, numbers)]
        counts = np.zeros(sum(n), np.int64)
        np.add.at(counts, np.repeat(np.arange(sum(n)), n_pieces), of_piece[numbers])
        return line, np.cumsum(counts) - counts, counts

    def _digests(self, table: pa.Array, ids: np.ndarray, edges: np.ndarray, joined: bool) -> list[str]:
        hashes, text = [hashlib.sha256() for _ in range(len(edges) - 1)], 0
        for start in range(0, len(ids), IDS_AT_ONCE):
            end = min(start + IDS_AT_ONCE, len(ids))
            written = table.take(pa.array(ids[start:end]))
            places = np.frombuffer(written.buffers()[1], np.int32)[: end - start + 1]
            data = memoryview(written.buffers()[2])
            while text < len(hashes):
                a, b = max(int(edges[text]), start), min(int(edges[text + 1]), end)
                if a < b:
                    hashes[text].update(data[places[a - start] : places[b - start] - (joined and b == edges[text + 1])])
                if edges[text + 1] > end:
                    break
                text += 1
        return [h.hexdigest() for h in hashes]

    def digests(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        """SHA-256 of each text's decimal ids, joined by a space."""
        return self._digests(self.decimal, ids, edges, True)

    def decoded_digests(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        """SHA-256 of the bytes that each text's ids stand for."""
        return self._digests(self.bytes, ids, edges, False)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``SLICE_BYTES`` each (one text at least)."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    begin, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > SLICE_BYTES:
            yield begin, k
            begin, held = k, 0
        held += int(size)
    if begin < len(sizes):
        yield begin, len(sizes)


#: The coders of this Python worker, by vocabulary.  Spark takes a broadcast from a worker whose next task doesn't use it, and its
#: coders go with it: workers live on, and would hold the tables beside what stages to come need.
_coders: WeakKeyDictionary[Broadcast, dict[tuple, TextCoder]] = WeakKeyDictionary()


def worker_coder(vocabulary: Broadcast, pattern: str, space_led: bool = False) -> TextCoder:
    """This Python worker's coder, made once for each broadcast."""
    made = _coders.setdefault(vocabulary, {})
    key = (pattern, space_led)
    if key not in made:
        made.clear()
        made[key] = TextCoder(parse_ranks(vocabulary.value), pattern, space_led)
        give_back()
    return made[key]


def read_vocabulary(df: DataFrame, path: str) -> Broadcast:
    """The rank file (under 1 MB) as a broadcast; read on the driver, where the path is a parameter of the call."""
    ship_package(df.sparkSession)
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_documents(df: DataFrame, path: str, pattern: str, *, space_led: bool = False, text: str = "text", keep: list[str] | None = None, with_ids: bool = True) -> DataFrame:
    """``keep`` columns of ``df`` and n_tokens, ids (array<int>, if asked for), ids_sha256, decoded_sha256.

    One pass without a shuffle.  The names of new columns win over those of ``keep``.
    """
    keep = [c for c in (keep or []) if c not in ("n_tokens", "ids", "ids_sha256", "decoded_sha256")]
    inner = [f"_k{n}" for n in range(len(keep))]
    narrow = df.select(*[df[c].alias(n) for c, n in zip(keep, inner)], df[text].alias("_text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    schema = ", ".join(x for x in (kinds, "n_tokens bigint", "ids array<int>" if with_ids else "", "ids_sha256 string", "decoded_sha256 string") if x)
    vocabulary = read_vocabulary(df, path)
    names = [*inner, "n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(vocabulary, pattern, space_led)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for begin, end in slices(texts):
                ids, edges = coder.encode_all(texts.slice(begin, end - begin))
                columns = [batch.column(k).slice(begin, end - begin) for k in range(len(keep))]
                columns.append(pa.array(np.diff(edges), pa.int64()))
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)))
                columns += [pa.array(f(ids, edges), pa.string()) for f in (coder.digests, coder.decoded_digests)]
                yield pa.RecordBatch.from_arrays(columns, names)
            give_back()

    out = narrow.mapInArrow(run, schema)
    return out.withColumnsRenamed(dict(zip(inner, keep)))


def decode_documents(df: DataFrame, path: str, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its id lists as binary column ``into`` (null for null)."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != into), f"`{into}` binary"])
    vocabulary = read_vocabulary(df, path)
    names = [c for c in df.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {v: k for k, v in parse_ranks(vocabulary.value).items()}
        for batch in batches:
            decoded = [None if (x := v.as_py()) is None else b"".join(token[k] for k in x) for v in batch.column(batch.schema.get_field_index(ids))]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(decoded, pa.binary())], [*names, into])

    return df.mapInArrow(run, schema)
