"""Token ids of whole texts by a public tokenizer.

Byte-level BPE never joins characters across the start of white space or from a letter to
punctuation, so a text may be cut there and each different piece be encoded once. Pieces repeat
a lot; looking their ids up in bulk is several times faster than encoding every text. The ids
are those of the whole text: with the tokenizer's added tokens found in it, as a plain call
gives, or with special ones spelt out like other text, so that their ids never occur.
"""

import functools
import json
import os
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pagelore.llm.texthash import SPACE, span_hashes, text_bytes

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
# ASCII punctuation but the apostrophe, which may belong to the letters after it.
_MARK = np.zeros(256, dtype=bool)
_MARK[33:127] = ~_WORD[33:127]
_MARK[39] = False
_WORD_CHARACTER = re.compile(r"\w")

KNOWN_PIECES = 1 << 19
RUN = 500
#: So many runs are encoded at a time, as the tokenizer's own results are large.
RUNS = 32
BLOCK = 1 << 18


def default_tokenizer() -> str:
    """Path of the public tokenizer file; every entry point takes another path as well."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start: at each text, at white space after a visible character, and at an
    ASCII mark after a letter or digit.

    A character beyond ASCII may be white space itself, so only ASCII and U+00C0 to U+00FF,
    which are none, count as visible. Elsewhere the text is just cut less often.
    """
    cut = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        here, last = data[1:], data[:-1]
        visible = (last > 32) & (last < 127)
        word = _WORD[last]
        if len(data) > 2:
            latin = (data[:-2] == 0xC3) & (last[1:] >= 0x80)
            visible[1:] |= latin
            word[1:] |= latin & (last[1:] != 0x97) & (last[1:] != 0xB7)
        cut[1:] = (SPACE[here] & visible) | (_MARK[here] & word)
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


def _joinable(piece: bytes) -> bool:
    """Whether such pieces may stand behind each other: from white space to a visible end."""
    if len(piece) < 2 or piece[0] not in b" \t\n\v\f\r":
        return False
    return 32 < piece[-1] < 127 or (piece[-2] == 0xC3 and piece[-1] >= 0x80)


@functools.cache
def encoder(path: str, added: bool = False) -> "Encoder":
    """One encoder for each tokenizer file, setting and Python worker."""
    return Encoder(path, added)


class AddedTokens:
    """Cuts texts at the added tokens of a tokenizer file, by the flags that each has."""

    def __init__(self, tokens: list[dict]):
        self._tokens = {t["content"]: t for t in tokens if t["content"]}
        # Those not subject to a normaliser are searched first, the others in what is left.
        passes = [[c for c, t in self._tokens.items() if bool(t["normalized"]) is late] for late in (False, True)]
        self._passes = [self._any_of(contents) for contents in passes if contents]
        self._hint = self._any_of(list(self._tokens)).pattern if self._tokens else None

    @staticmethod
    def _any_of(contents: list[str]) -> re.Pattern:
        return re.compile("|".join(map(re.escape, sorted(contents, key=len, reverse=True))))

    def occur(self, column: pa.Array) -> np.ndarray:
        """Whether each text may hold an added token."""
        if self._hint is None:
            return np.zeros(len(column), dtype=bool)
        found = pc.match_substring_regex(pc.fill_null(column, ""), self._hint)
        return found.to_numpy(zero_copy_only=False)

    def cut(self, text: str) -> tuple[list[str], list[int]]:
        """The texts between added tokens, and the ids of those: one less than there are texts."""
        texts, ids = [text], []
        for pattern in self._passes:
            between, found = [], []
            for i, part in enumerate(texts):
                some, more = self._cut_by(pattern, part)
                between += some
                found += more + ids[i : i + 1]
            texts, ids = between, found
        return texts, ids

    def _cut_by(self, pattern: re.Pattern, text: str) -> tuple[list[str], list[int]]:
        texts, ids, at = [], [], 0
        for m in pattern.finditer(text):
            (start, stop), token = m.span(), self._tokens[m[0]]
            if token["single_word"] and _WORD_CHARACTER.match(text[max(start - 1, 0) : start] or " "):
                continue
            if token["single_word"] and _WORD_CHARACTER.match(text[stop : stop + 1] or " "):
                continue
            while token["lstrip"] and start > at and text[start - 1].isspace():
                start -= 1
            while token["rstrip"] and stop < len(text) and text[stop].isspace():
                stop += 1
            texts.append(text[at:start])
            ids.append(token["id"])
            at = stop
        return [*texts, text[at:]], ids


class Encoder:
    """Encodes Arrow columns of text. Needs a byte-level BPE tokenizer without a normaliser.

    With ``added``, added tokens in a text get their own ids, as ``encode`` of the file gives
    them; without, special ones are spelt out. At most ``KNOWN_PIECES`` pieces are remembered
    between calls.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        # A task has one core; threads of the tokenizer's own would each keep memory, too.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = whole = Tokenizer.from_file(path)
        self._added = AddedTokens([])
        if added:  # they are cut out before, so the tokenizer itself must not look for them
            data = json.loads(Path(path).read_text("utf-8"))
            self._added = AddedTokens(data.get("added_tokens", []))
            self._tokenizer = Tokenizer.from_str(json.dumps(data | {"added_tokens": [], "post_processor": None}))
        self._tokenizer.encode_special_tokens = True
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        if self._tokenizer.normalizer is not None:
            raise ValueError("the tokenizer changes texts before cutting them")
        if "ByteLevel" not in repr(self._tokenizer.pre_tokenizer):
            raise ValueError("the tokenizer is no byte-level BPE")
        self.vocabulary = whole.get_vocab_size()
        self._bytes = np.zeros(self.vocabulary, dtype=np.int64)
        for token, i in whole.get_vocab().items():
            self._bytes[i] = len(token)  # byte-level tokens have a character for each byte
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self._forget()

    def _forget(self) -> None:
        # Hashes of the known pieces, ascending, and the number of each piece.
        self._hashes = np.zeros(0, dtype=np.uint64)
        self._numbers = np.zeros(0, dtype=np.int64)
        self._ids = np.zeros(1 << 16, dtype=self.dtype)
        self._starts = np.zeros(1, dtype=np.int64)

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash among the known ones, and whether it stands there."""
        at = np.searchsorted(self._hashes, hashes)
        there = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self._hashes)
        there[inside] = self._hashes[at[inside]] == hashes[inside]
        return at, there

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        joinable = [_joinable(piece) for piece in pieces]
        plain = [i for i, yes in enumerate(joinable) if yes]
        other = [i for i, yes in enumerate(joinable) if not yes]
        ids, lengths = self._encode_joined([pieces[i] for i in plain])
        found = self._encode_each([pieces[i] for i in other])
        more = np.fromiter((i for x in found for i in x), dtype=self.dtype)
        lengths = np.concatenate([lengths, np.fromiter(map(len, found), dtype=np.int64)])
        known, used = len(self._starts) - 1, int(self._starts[-1])
        needed = used + len(ids) + len(more)
        if needed > len(self._ids):
            room = np.zeros(needed, dtype=self.dtype)
            self._ids = np.concatenate([self._ids[:used], room])
        self._ids[used : used + len(ids)] = ids
        self._ids[used + len(ids) : needed] = more
        self._starts = np.concatenate([self._starts, used + np.cumsum(lengths)])
        learnt = hashes[np.array(plain + other, dtype=np.int64)]
        order = np.argsort(learnt)
        at = np.searchsorted(self._hashes, learnt[order])
        self._hashes = np.insert(self._hashes, at, learnt[order])
        self._numbers = np.insert(self._numbers, at, known + order)

    def _encode_each(self, pieces: list[bytes]) -> list[list[int]]:
        texts = [piece.decode() for piece in pieces]
        batch = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in batch]

    def _encode_joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces, and their number for each piece.

        One call takes a long run of pieces; the bytes that each id stands for tell where a
        piece's ids end.
        """
        if not pieces:
            return np.zeros(0, dtype=self.dtype), np.zeros(0, dtype=np.int64)
        runs = [b"".join(pieces[i : i + RUN]) for i in range(0, len(pieces), RUN)]
        ids = np.concatenate([
            np.array(x, dtype=self.dtype)
            for i in range(0, len(runs), RUNS) for x in self._encode_each(runs[i : i + RUNS])
        ])
        ends = np.cumsum(self._bytes[ids])
        wanted = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
        stops = np.searchsorted(ends, wanted)
        if not np.array_equal(ends[stops], wanted):
            raise RuntimeError("a token crosses the start of a piece")
        return ids, np.diff(stops + 1, prepend=0)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids behind each other, and where each text's ids start; null is empty."""
        hits = self._added.occur(column)
        if not hits.any():
            return self._encode_plain(column)
        parts, own, begins, owns = [], [], [0], [0]  # texts and added tokens before each text
        for text, hit in zip(column.to_pylist(), hits.tolist()):
            texts, ids = self._added.cut(text) if hit else ([text], [])
            parts += texts
            # An added token stands before the part that follows it.
            own += zip(range(len(parts) - len(ids), len(parts)), ids)
            begins.append(len(parts))
            owns.append(len(own))
        ids, first = self._encode_plain(pa.array(parts, column.type))
        before = np.array([part for part, _ in own], dtype=np.int64)
        given = np.array([i for _, i in own], dtype=self.dtype)
        return np.insert(ids, first[before], given), first[begins] + np.array(owns)

    def _encode_plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(column)
        starts = piece_starts(data, offsets)
        ids, stops, used = [np.zeros(0, dtype=self.dtype)], [np.zeros(1, dtype=np.int64)], 0
        for i in range(0, len(starts), BLOCK):
            block = starts[i : i + BLOCK + 1]
            last = int(block[BLOCK]) if len(block) > BLOCK else len(data)
            some, lengths = self._encode_pieces(data, block[:BLOCK], last)
            ids.append(some)
            stops.append(used + np.cumsum(lengths))
            used += len(some)
        return np.concatenate(ids), np.concatenate(stops)[np.searchsorted(starts, offsets)]

    def _encode_pieces(
        self, data: np.ndarray, starts: np.ndarray, last: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of neighbouring pieces, and their number for each piece."""
        ends = np.append(starts[1:], last)
        found = pa.array(span_hashes(data, starts, ends)).dictionary_encode()
        codes, hashes = found.indices.to_numpy(), found.dictionary.to_numpy()
        if len(self._hashes) + len(hashes) > KNOWN_PIECES:
            self._forget()
        example = np.empty(len(hashes), dtype=np.int64)
        example[codes[::-1]] = np.arange(len(codes))[::-1]
        new = np.flatnonzero(~self._known(hashes)[1])
        if len(new):
            at = example[new]
            base = int(starts[0])
            raw = data[base:last].tobytes()
            spans = zip((starts[at] - base).tolist(), (ends[at] - base).tolist())
            self._learn(hashes[new], [raw[s:e] for s, e in spans])
        place = self._numbers[self._known(hashes)[0]][codes]
        lengths = (self._starts[1:] - self._starts[:-1])[place]
        before = np.cumsum(lengths) - lengths
        source = np.repeat(self._starts[place] - before, lengths) + np.arange(lengths.sum())
        return self._ids[source], lengths
