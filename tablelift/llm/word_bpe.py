"""Token ids of a public ``tokenizers`` vocabulary at corpus speed.

The vocabulary drops white space and never merges across it, so a text's ids are the ids of its
ASCII-white-space runs one after the other. A plain span of text (visible ASCII, white space and
letters of Latin-1, no special token) is lower-cased and cut into pieces by the vocabulary's own
pattern, and each piece goes straight to the library's BPE model (its normalizer and splitter do no
more to such text). The runs of any other span go through the whole tokenizer. Pieces and runs are
encoded once and kept in a cache bounded by bytes; those too long for it are encoded each time.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

CACHE_BYTES, ENTRY_BYTES, LONGEST = 48 << 20, 150, 4096
SPAN = 16 << 10  # bytes of text judged at once; cut at white space
SPACE = re.compile(rb"[ \t-\r]")
PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
# The vocabulary's pattern on plain, lower-cased text: endings, letters, one digit, punctuation.
PIECE = re.compile("'(?:[stmd]|re|ve|ll)|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[!-/:-@\\[-`{-~]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: visible Latin-1
    characters stand for themselves, the other bytes for U+0100 onwards in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordBpe(dict):
    """Encoder of one task: piece of plain text -> its ids, packed as unsigned integers."""

    def __init__(self, path: str, end_id: int, code: str = "I"):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok, self.end, self.code = Tokenizer.from_file(path), end_id, code
        self.model = self.tok.model
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.runs: dict[bytes, bytes] = {}
        self.room = CACHE_BYTES  # of both caches together
        self.letters = byte_letters()

    def _pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _keep(self, cache: dict, key, ids: bytes) -> bytes:
        """Cache ``ids`` within the byte budget; a full one starts anew."""
        size = len(key) + len(ids) + ENTRY_BYTES
        if size <= LONGEST:
            if size > self.room:
                self.clear(), self.runs.clear()
                self.room = CACHE_BYTES
            self.room -= size
            cache[key] = ids
        return ids

    def __missing__(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return self._keep(self, piece, self._pack([t.id for t in self.model.tokenize(shown)]))

    def _run(self, run: bytes) -> bytes:
        text = run.decode()
        ids = self._plain(text)
        if ids is None:
            ids = self._pack(self.tok.encode(text, add_special_tokens=False).ids)
        return self._keep(self.runs, run, ids)

    def _plain(self, text: str) -> bytes | None:
        """Ids of plain text, piece by piece; None for any other."""
        if not PLAIN.fullmatch(text) or any(t in text for t in self.special):
            return None
        return b"".join(map(self.__getitem__, PIECE.findall(text.lower())))

    def _spans(self, text: bytes) -> Iterator[bytes]:
        """The text in order, cut before the first white space from SPAN bytes on."""
        at = 0
        while at < len(text):
            cut = SPACE.search(text, at + SPAN)
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end

    def _ids(self, span: bytes) -> bytes:
        ids = self._plain(span.decode())
        return b"".join([self.runs.get(r) or self._run(r) for r in span.split()]) if ids is None else ids

    def texts(self, texts: list) -> list[bytes]:
        """Packed ids of each text (None: empty) and the end id."""
        end = self._pack([self.end])
        return [b"".join(map(self._ids, self._spans(t))) + end if t else end for t in texts]
