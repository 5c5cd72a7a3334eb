"""Token ids of whole texts, chunk by chunk.

A byte-level tokenizer never merges across the last white space before a word, a word tokenizer drops white
space altogether. So a text is cut at these places, the ``tokenizers`` library encodes each chunk that has not
been met yet (many in one call), and frequent chunks come from a bounded cache. The ids equal those of the
whole text encoded at once; the tests compare both.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

# Unicode White_Space, the tokenizers' own meaning of \s.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CUTS = re.compile(f"(?=[{SPACE}][^{SPACE}])")
UNUSUAL_ASCII = "\t\r\x0b\x0c"
UNUSUAL_REST = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
START = "\ue000"  # marks the first chunk of a text, which no space precedes
WHITE = set(" \n" + UNUSUAL_ASCII + UNUSUAL_REST)
LATER = re.compile(f"[{SPACE}]?[^{SPACE}{START}][^{SPACE}]*")
ANY = re.compile(f"[^{SPACE}]+")
CACHED_CHUNKS = 1_000_000
LONGEST_CACHED = 48
TEXTS_AT_ONCE = 256


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process."""
    return ChunkEncoder(path)


def is_plain(text: str) -> bool:
    """No white space but spaces and line ends."""
    return not any(c in text for c in UNUSUAL_ASCII) and (text.isascii() or not any(c in text for c in UNUSUAL_REST))


class ChunkEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.spaces_matter = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["type"] == "ByteLevel"
        self.ids: dict[str, bytes] = {}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        out = []
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            parts = [self.chunks(t) for t in texts[at:at + TEXTS_AT_ONCE]]
            new = set().union(*parts).difference(self.ids)
            self.learn(new)
            out += [b"".join(map(self.ids.__getitem__, p)) for p in parts]
            room = CACHED_CHUNKS - len(self.ids)
            for c in new if room < 0 else (c for c in new if len(c) > LONGEST_CACHED):
                del self.ids[c]
        return out

    def chunks(self, text: str) -> list[str]:
        if not self.spaces_matter:
            return text.split(" ")
        if START in text:
            return [START + text]
        if is_plain(text):
            out: list[str] = []
            for line in text.split("\n"):
                words = line.split(" ")
                words[0] = "\n" + words[0]
                out += words
            out[0] = START + out[0][1:]
            if "" not in out and "\n" not in out:
                return out
        first, *rest = CUTS.split(text)
        return [START + first, *(c[1:] if c[0] == " " else c for c in rest)]

    def whole(self, chunk: str) -> str:
        """The text that a chunk stands for: a space before a word of a byte-level tokenizer is left out in the key."""
        if not self.spaces_matter:
            return chunk
        return chunk[1:] if chunk[0] == START else chunk if chunk[0] in WHITE else " " + chunk

    def learn(self, new: set[str]) -> None:
        """Encode new chunks: those that may stand in a row as one text, the others one by one."""
        row = [c for c in new if (LATER if self.spaces_matter else ANY).fullmatch(c)]
        for c in new.difference(row):
            self.ids[c] = np.asarray(self.tokenizer.encode(self.whole(c), add_special_tokens=False).ids, "<u4").tobytes()
        texts = [self.whole(c) if self.spaces_matter else c + " " for c in row]
        for at in range(0, len(row), 2000):
            part = texts[at:at + 2000]
            got = self.tokenizer.encode("".join(part), add_special_tokens=False)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
            last = np.fromiter((e for _, e in got.offsets), np.int64, len(got)) - 1
            cut = 4 * np.searchsorted(last, ends)
            ids = np.asarray(got.ids, "<u4").tobytes()
            self.ids.update(zip(row[at:at + 2000], (ids[a:b] for a, b in zip(np.r_[0, cut[:-1]].tolist(), cut.tolist()))))
