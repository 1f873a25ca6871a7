"""Ids of whole texts by a vocabulary file of the tokenizers library, one word at a time.

The vocabularies meant here drop white space and never merge across it, so the ids of a
text are those of its ASCII-white-space separated words in turn.  Each task remembers the
words that it has met; only new words reach the library.  ``of_array`` looks up every different
word of an array of texts once, and puts the ids together in whole arrays.
"""

import os
import string
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ID_BYTES = 4  # little-endian unsigned 32-bit
END_ID = (1).to_bytes(ID_BYTES, "little")
#: Signs that end words without changing how the letters before them are split.
TRAILING = b'.,!?;:*$%&#|")]}'
#: Lead bytes of the combining marks that NFC composes with ASCII letters.
MARK_LEADS = (b"\xcc", b"\xcd")
#: The signs with these lead bytes.
MARKS = r"[\x{300}-\x{37f}]"
#: By byte: whether it parts words.
WHITE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: Words that the library gets in one call, and that are put together at a time.
CALL_WORDS = 2048
JOINED_WORDS = 1 << 20


def _as_bytes(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def _halves(word: bytes) -> tuple[bytes, bytes]:
    """The word without the signs that end it, and these; or all of it and nothing."""
    core = word.rstrip(TRAILING)
    if core and len(core) < len(word) and core.decode()[-1].isalnum():
        return core, word[len(core):]
    return word, b""


def _numbered_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different words, the number of every word, and where the words of each text end.

    A word in the texts' buffer reaches up to the next, so white space behind it is taken off.
    """
    edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(edges[0]), int(edges[-1])
    if first == last:
        return [], np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    black = ~WHITE[np.frombuffer(texts.buffers()[2], np.uint8)[first:last]]
    begins = black.copy()
    begins[1:] &= ~black[:-1]
    inside = edges[edges < last] - first
    begins[inside] = black[inside]  # the first sign of a text, whatever ends the text before
    starts = np.append(np.flatnonzero(begins) + first, last).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), texts.buffers()[2]])
    encoded = words.dictionary_encode()
    different = [word.rstrip() for word in encoded.dictionary.to_pylist()]
    return different, encoded.indices.to_numpy(), np.searchsorted(starts[:-1], edges[1:])


class WordIds(dict):
    """UTF-8 word to its ids as bytes.

    After ``limit`` new words it starts afresh, but words met again are taken over from the
    generation before; so what is remembered is bounded and common words stay.
    """

    def __init__(self, vocabulary: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model if self._leaves_letters() else None
        self.limit = limit
        self.before: dict[bytes, bytes] = {}

    def _leaves_letters(self) -> bool:
        """Whether a word of small ASCII letters reaches the library's model as it is, and alone."""
        t, letters = self.tokenizer, string.ascii_lowercase
        if t.post_processor or t.truncation or t.padding or not t.pre_tokenizer:
            return False
        if any(set(x.content) <= set(letters) for x in t.get_added_tokens_decoder().values()):
            return False
        normal = t.normalizer.normalize_str(letters) if t.normalizer else letters
        return t.pre_tokenizer.pre_tokenize_str(normal) == [(letters, (0, len(letters)))]

    def _of_new(self, words: list[bytes]) -> list[bytes]:
        """The ids that the library gives, its model at once where nothing comes before it."""
        tokenize = self.model.tokenize if self.model else None
        ids = [_as_bytes([t.id for t in tokenize(w.decode())]) if tokenize and w.isalpha() and w.islower() else None for w in words]
        rest = [i for i, known in enumerate(ids) if known is None]
        found = self.tokenizer.encode_batch([words[i].decode() for i in rest], add_special_tokens=False)
        for i, x in zip(rest, found, strict=True):
            ids[i] = _as_bytes(x.ids)
        return ids

    def _encode(self, text: str) -> bytes:
        return _as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: bytes) -> bytes:
        core, end = _halves(word)
        if end:
            return self[core] + self[end]  # not kept: both parts are
        ids = self.before.get(word)
        if ids is None:
            (ids,) = self._of_new([word])
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def of_text(self, text: str) -> bytes:
        """The ids of the whole text, without special ids of its own."""
        raw = text.encode()
        if b"<|" in raw:  # a special token's string, which the library finds across words
            return self._encode(text)
        if not any(lead in raw for lead in MARK_LEADS):
            raw = raw.lower()  # the vocabulary lower-cases; fewer words to remember
        return b"".join(map(self.__getitem__, raw.split()))

    def of_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word; the library gets all new ones together."""
        ids = list(map(self.get, words))
        before, halves, met, new = self.before, {}, {b"": b""}, {}
        for i in (i for i, known in enumerate(ids) if known is None):
            halves[i] = pair = _halves(words[i])
            for half in pair:
                if half not in met and half not in new:
                    known = self.get(half, before.get(half))
                    if known is None:
                        new[half] = None
                    else:
                        met[half] = known
        fresh = list(new)
        for at in range(0, len(fresh), CALL_WORDS):
            call = fresh[at : at + CALL_WORDS]
            met.update(zip(call, self._of_new(call), strict=True))
        for i, (core, end) in halves.items():
            ids[i] = met[core] + met[end]
        del met[b""]
        if len(self) + len(met) > self.limit:
            self.before = dict(self)
            self.clear()
        self.update(met)
        return ids

    def of_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and the number of each text's ids."""
        texts = texts.cast(pa.string())
        special = pc.match_substring(texts, "<|")  # as in of_text
        plain = pc.if_else(pc.match_substring_regex(texts, MARKS), texts, pc.ascii_lower(texts))
        words, numbers, ends = _numbered_words(pc.if_else(special, "", plain))
        ids = self.of_words(words)
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // ID_BYTES
        start, table = np.cumsum(length) - length, np.frombuffer(b"".join(ids), "<u4")
        joined, upto = [np.empty(0, "<u4")], [np.zeros(1, np.int64)]
        for at in range(0, len(numbers), JOINED_WORDS):
            these = numbers[at : at + JOINED_WORDS]
            each = length[these]
            after = np.cumsum(each)
            joined.append(table[np.repeat(start[these] - (after - each), each) + np.arange(int(after[-1]))])
            upto.append(after + upto[-1][-1])
        found = np.concatenate(joined)
        text_ends = np.concatenate(upto)[ends]
        counts = np.diff(text_ends, prepend=0)
        alone = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        if len(alone):
            own = [np.frombuffer(self._encode(texts[i].as_py()), "<u4") for i in alone.tolist()]
            counts[alone] = [len(x) for x in own]
            found = np.insert(found, np.repeat(text_ends[alone], counts[alone]), np.concatenate(own))
        return found, counts


#: Words that a generation remembers, about 170 bytes each.
REMEMBERED = 500_000
_known: dict[tuple, WordIds] = {}


def word_ids(vocabulary: str, remembered: int = REMEMBERED) -> WordIds:
    """The words met so far by this Python worker."""
    if (vocabulary, remembered) not in _known:
        _known[vocabulary, remembered] = WordIds(vocabulary, remembered)
    return _known[vocabulary, remembered]
