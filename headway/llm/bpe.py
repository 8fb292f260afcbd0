"""Byte-level BPE by backtracking over longest matches.

The bytes of a piece become Latin-1 characters, so that an Aho-Corasick trie
finds the longest vocabulary entry at a position. The encoder takes longest
matches and steps back wherever two neighbours could not stand side by side
after exact merging; that test is memoised. Each position is entered at most
once per boundary, so the time is linear in the text.

Defined results: a null text counts as empty; an empty text has no ids; repeated
rows get equal results; extra columns are not read. Long pieces are not cut.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame

from headway.llm.common import add_columns

#: A rank file above this size is refused, as it is sent to every executor.
MAX_RANK_BYTES = 64 << 20
#: Entries of the memo of neighbours and of the cache of pieces; a full one is emptied.
MEMO_PAIRS, CACHE_PIECES = 1_000_000, 600_000


class Bpe:
    """One vocabulary: ids are merge ranks, single bytes included."""

    def __init__(self, rank_file: bytes, pattern: str):
        import ahocorasick
        import regex

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.ranks, self.bytes_of = ranks, [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.sizes = list(map(len, self.bytes_of))
        self.longest, self.prefixes, self.paths = max(self.sizes), {}, {}
        self.merges, self.halves, self.pairs, self.pieces = {}, {}, {}, {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                parts = self._merged(token, rank)
                if len(parts) == 2:
                    self.halves[rank] = tuple(parts)
                    self.merges[tuple(parts)] = rank
        self.split = regex.compile(pattern).findall

    def _merged(self, token: bytes, below: int) -> list[int]:
        """The ids that are left of a token when only merges of lower ranks are applied."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [(self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(found)
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether exact merging leaves these two neighbours apart."""
        if len(self.pairs) > MEMO_PAIRS:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # Undo the younger of the two tokens step by step: at no step may the facing parts have an earlier merge.
        limit = len(self.bytes_of)
        while True:
            if self.merges.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, halves = left, self.halves.get(left)
                if halves is not None:
                    left = halves[1]
                    continue
                limit, halves = right + 1, self.halves.get(right)
                if halves is None:
                    return True
                right = halves[0]
            else:
                limit, halves = right + 1, self.halves.get(right)
                if halves is not None:
                    right = halves[0]
                    continue
                limit, halves = left, self.halves.get(left)
                if halves is None:
                    return True
                left = halves[1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, chars, sizes, pairs, match = len(piece), piece.decode("latin-1"), self.sizes, self.pairs, self.longest_match
        out, closed, at, token, last = [], set(), 0, match(chars, 0), -1
        while at < n:
            end = at + sizes[token]
            fits = end not in closed
            if fits and last >= 0:
                fits = pairs.get(last << 32 | token)
                if fits is None:
                    fits = self.compatible(last, token)
            if fits:
                out.append(token)
                at, last = end, token
                token = match(chars, at) if at < n else -1
                continue
            token = self.shorter(token)
            if token < 0:  # nothing fits here: close the position and shorten the token before it
                closed.add(at)
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1
        return out

    def longest_match(self, chars: str, at: int) -> int:
        """The longest vocabulary entry that starts here; its first byte is one at least."""
        window = chars[at:at + self.longest]
        path = window[:self.automaton.longest_prefix(window)]
        token = self.paths.get(path)
        if token is None:  # a path of the trie may end inside an entry
            entry = path
            while (token := self.automaton.get(entry, -1)) < 0:
                entry = entry[:-1]
            self.paths[path] = token
        return token

    def shorter(self, token: int) -> int:
        """The longest entry that is a proper prefix of an entry, or -1."""
        found = self.prefixes.get(token)
        if found is None:
            prefix, found = self.bytes_of[token][:-1], -1
            while prefix and found < 0:
                found, prefix = self.ranks.get(prefix, -1), prefix[:-1]
            self.prefixes[token] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        known, parts = self.pieces, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
                if len(piece) <= 64:
                    if len(known) > CACHE_PIECES:
                        known.clear()
                    known[piece] = ids
            parts.append(ids)
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_MODELS: dict[tuple[str, str], Bpe] = {}


def model(rank_file: bytes, pattern: str) -> Bpe:
    """The vocabulary of a rank file; a Python process builds it once."""
    key = (hashlib.sha256(rank_file).hexdigest(), pattern)
    if key not in _MODELS:
        _MODELS[key] = Bpe(rank_file, pattern)
    return _MODELS[key]


def byte_bpe(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str] | None = None, ids: bool = False) -> DataFrame:
    """Append n_tokens, ids_sha256 and decoded_sha256 to the kept columns, and the ids themselves on request.

    They take the place of input columns with the same names, in any case of letters.
    The rank file is read on the driver, so executors need no copy of it.
    """
    with open(ranks_path, "rb") as f:
        rank_file = f.read()
    if len(rank_file) > MAX_RANK_BYTES:
        raise ValueError(f"{ranks_path} has {len(rank_file)} bytes; at most {MAX_RANK_BYTES} can be sent to executors")
    sent = docs.sparkSession.sparkContext.broadcast(rank_file)
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def make():
        bpe = model(sent.value, pattern)

        def run(texts):
            encoded = [bpe.encode(t) if t else b"" for t in texts]
            out = [[len(x) // 4 for x in encoded], [sha(x) for x in encoded], [sha(bpe.decode(x)) for x in encoded]]
            return [*out, [np.frombuffer(x, "<u4").astype(np.int64) for x in encoded]] if ids else out
        return run

    columns = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"} | ({"ids": "array<bigint>"} if ids else {})
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in columns]
    return add_columns(docs, make, columns, keep=kept)
