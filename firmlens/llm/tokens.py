"""Token ids of whole texts by a tokenizer file, with a bounded memory of words."""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Bytes of words and of pieces that a worker remembers with their ids; all others are encoded again.
#: Each is counted with its ids and what Python adds, and held at most twice (kept and recent).
WORDS_BYTES = 24 << 20
PIECES_BYTES = 16 << 20
ENTRY_BYTES = 180
WORDS_AT_ONCE = 4096

# The pre-tokenizer's pattern for the letters and numbers up to U+024F (and the space that
# parts words), and white space that may be seen within a word.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^ {_L}{_N}]+| ")
BEYOND_LATIN = re.compile("[^\x00-\u024f]")
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_tokenizer(path: str | None = None) -> str:
    """The file's content, which is what goes to the executors."""
    with open(path or word_tokenizer_path(), encoding="utf-8") as file:
        return file.read()


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memory:
    """Ids by word, for words that came more than once; a first meeting is kept for a while only, so
    words that never come again don't take the room. ``limit`` bounds the bytes of either part."""

    def __init__(self, limit: int):
        self.limit, self.kept, self.recent = limit, {}, {}
        self.kept_bytes = self.recent_bytes = 0

    @staticmethod
    def _bytes(entries: dict) -> int:
        return ENTRY_BYTES * len(entries) + sum(map(len, entries)) + sum(map(len, entries.values()))

    def take(self, missing: set) -> dict:
        """Ids of those of ``missing`` that were met before."""
        again = {w: self.recent[w] for w in missing & self.recent.keys()}
        if again and self.kept_bytes < self.limit:
            self.kept |= again
            self.kept_bytes += self._bytes(again)
        return again

    def add(self, new: dict) -> None:
        if self.recent_bytes >= self.limit:
            self.recent, self.recent_bytes = {}, 0
        self.recent |= new
        self.recent_bytes += self._bytes(new)


class WordEncoder:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    The tokenizer parts words at white space and nothing it does reaches across, so a text's ids are
    its words' ids in a row. Words that aren't remembered are normalised together, cut by the
    tokenizer's pattern, and each new piece goes through its model. Words that hold a special token
    or odd white space go through the whole tokenizer.
    """

    BREAK = b"\xff\xff\xff\xff"  # no id

    def __init__(self, content: str, words_bytes: int = WORDS_BYTES, pieces_bytes: int = PIECES_BYTES):
        self.tokenizer = Tokenizer.from_str(content)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.words, self.pieces = Memory(words_bytes), Memory(pieces_bytes)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _plain(self, word: str) -> bool:
        """Whether its lower case is its normal form: Latin letters are composed already."""
        return not (BEYOND_LATIN.search(word.lower()) or ODD_SPACE.search(word) or any(s in t for s in self.special for t in (word, word.lower())))

    def _alone(self, word: str) -> bytes:
        normal = self.tokenizer.normalizer.normalize_str(word)
        if ODD_SPACE.search(word) or any(s in t for s in self.special for t in (word, normal)):
            return self.whole(word)
        return b"".join(self._merged(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def _encoded(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, many at a time. Those that are not plain Latin are done one by one."""
        joined = " ".join(words)
        text = joined.lower()
        if BEYOND_LATIN.search(text) or ODD_SPACE.search(text) or any(s in t for s in self.special for t in (joined, text)):
            plain = [w for w in words if self._plain(w)]
            found = {w: self._alone(w) for w in set(words) - set(plain)}
            return found | (self._encoded(plain) if plain else {})
        pieces = PIECES.findall(text)
        kept = self.pieces.kept
        missing = {p for p in pieces if p not in kept}
        missing.discard(" ")
        found = self.pieces.take(missing)
        new = {
            p: self._merged((p if p.isascii() else p.encode().decode("latin-1")).translate(self.letters))
            for p in missing - found.keys()
        }
        self.pieces.add(new)
        found |= new
        found[" "] = self.BREAK
        ids = b"".join([found[p] if (known := kept.get(p)) is None else known for p in pieces])
        return dict(zip(words, ids.split(self.BREAK), strict=True))

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        ids = list(map(self.words.kept.get, words))
        missing = {w for w, i in zip(words, ids, strict=True) if i is None}
        found = self.words.take(missing)
        rest, new = list(missing - found.keys()), {}
        for at in range(0, len(rest), WORDS_AT_ONCE):
            new |= self._encoded(rest[at : at + WORDS_AT_ONCE])
        self.words.add(new)
        found |= new
        return [found[w] if i is None else i for w, i in zip(words, ids, strict=True)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null is empty) in a row, and where each text's begin and the last's
        end. Arrow parts and numbers the words, so each distinct one is looked up once."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        numbered = lists.flatten().dictionary_encode()
        codes = numbered.indices.to_numpy(zero_copy_only=False)
        ids = self._known(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        table = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = (np.cumsum(sizes) - sizes)[codes] if len(ids) else np.zeros(0, np.int64)
        each = sizes[codes] if len(ids) else begin
        end = np.cumsum(each)
        total = int(end[-1]) if len(end) else 0
        narrow = np.int32 if total < 1 << 31 and len(table) < 1 << 31 else np.int64
        places = np.arange(total, dtype=narrow)
        places -= np.repeat((end - each - begin).astype(narrow), each)
        stops = np.concatenate([[0], end])
        offsets = lists.offsets.to_numpy()
        return table[places], stops[offsets - offsets[0]]

    def with_end(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        """The ids of each text, ``end_id`` last."""
        ids, at = self.encode(texts)
        return [np.append(ids[a:b], np.uint32(end_id)) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


@functools.lru_cache(maxsize=1)
def encoder(content: str) -> WordEncoder:
    """One encoder for each worker process, kept between tasks."""
    return WordEncoder(content)
