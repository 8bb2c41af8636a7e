"""Token ids of whole texts by a public tokenizer, with words remembered between texts."""

from __future__ import annotations

import os
import unicodedata
from itertools import islice, pairwise
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Stretches of letters and of marks: each is one piece to the vocabulary's own rules, if there
#: is no apostrophe (short forms such as 's), number, combining mark or other white space.
_SIMPLE = regex.compile(r"(?:\p{L}+|[\p{P}\p{S}--']+)+", regex.V1)
_PIECE = regex.compile(r"\p{L}+|[^\p{L}]+")
#: Marks of ASCII, without the apostrophe.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: The letters that stand for bytes in the vocabulary, where they are not those of Latin-1.
_BYTES = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


#: Bytes of text whose words are looked up together.
_PART = 8 << 20


def _as(kind: pa.DataType, texts: pa.Array) -> pa.Array:
    """Bytes as text or text as bytes, without a look at them."""
    return pa.Array.from_buffers(kind, len(texts), texts.buffers(), offset=texts.offset)


class _Memory(dict):
    """Ids of words; what found no room is kept for the current call only."""

    passing: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        return self.passing[word]


class WordTokens:
    """Ids of a text as little-endian 32-bit integers, equal to encoding the whole text.

    The vocabulary's rules work within stretches without white space (it drops white space and
    splits there first), so a text's ids are the ids of its words one after another.  ASCII
    white space is enough to cut at; what lies between may hold other white space.  Added tokens
    in a text (``<|endoftext|>``) are the one id they have, as in a plain call.  Words met
    before are looked up; at most ``remember`` of them are kept, which takes about 0.2 KB each.
    """

    def __init__(self, path: str, remember: int):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._added = regex.compile("|".join(map(regex.escape, added)) or r"(?!)")
        self._added_lower = regex.compile(self._added.pattern.lower().encode())
        self._model = self._tokenizer.model
        trial = ["the", "Xylophonists", "mañanas", "ÉÄßþÿª", "...", "$%"]
        self._direct = all(self._piece(t) == self._alone(t) for t in trial)
        self._known = _Memory()
        self._room = remember

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        part, size = [], 0
        for text in texts:
            raw = text.encode("utf-8", "surrogatepass")
            # The vocabulary is lower case; for ASCII text that is the same before as after.  Only
            # the added tokens are found before, as they are written.
            small = raw.lower() if raw.isascii() else raw
            part.append(raw if self._added_lower.search(small) else small)
            size += len(raw)
            if size > _PART:
                out += self._ids(part)
                part, size = [], 0
        return out + self._ids(part) if part else out

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts by their different words, each looked up once; the rest is array work."""
        raw = pa.array(texts, pa.large_binary())
        words = pc.ascii_split_whitespace(_as(pa.large_string(), raw))
        coded = _as(pa.large_binary(), words.values).dictionary_encode()
        different = coded.dictionary.to_pylist()
        known = self._known
        fresh = {word for word in different if word not in known}
        if fresh:
            found = self._look_up(fresh)
            free = self._room - len(known)
            known.update(found if len(found) <= free else islice(found.items(), max(0, free)))
            known.passing = found
        ids = [known[word] for word in different]
        of_word = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, begin = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(of_word) - of_word
        place = coded.indices.to_numpy()
        length = of_word[place]
        end = np.concatenate([[0], np.cumsum(length)])
        whole = flat[np.arange(end[-1]) + np.repeat(begin[place] - end[:-1], length)]
        cuts = end[words.offsets.to_numpy()].tolist()
        return [whole[a:b].tobytes() for a, b in pairwise(cuts)]

    def _look_up(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words, by their pieces where the pieces are simple."""
        out: dict[bytes, bytes] = {}
        parts: dict[bytes, list[str]] = {}
        stems: dict[str, bytes] = {}
        tails: dict[str, bytes] = {}
        for word in words:
            text = word.decode("utf-8", "replace")
            stem = text.rstrip(_MARKS)
            if self._direct and stem.isalpha() and (stem.isascii() or max(stem) <= "\xff"):
                tail = text[len(stem) :]
                own = stems.get(stem)
                if own is None:
                    own = self._known.get(stem.encode()) if tail else None
                    own = stems[stem] = self._piece(stem) if own is None else own
                if tail and tail not in tails:
                    tails[tail] = self._piece(tail)
                out[word] = own + tails[tail] if tail else own
                continue
            # Some letters fall apart into letters and combining marks.
            plain = text if text.isascii() else unicodedata.normalize("NFC", text).lower()
            if self._added.search(text):
                out[word] = self._alone(text)
            elif text.isalpha() and (plain is text or plain.isalpha()):
                parts[word] = [text]
            elif _SIMPLE.fullmatch(text) and (plain is text or _SIMPLE.fullmatch(plain)):
                parts[word] = _PIECE.findall(text)
            else:
                out[word] = self._alone(text)
        pieces = {piece for own in parts.values() for piece in own}
        ids = {piece: self._known[key] for piece in pieces if (key := piece.encode()) in self._known}
        rest = [piece for piece in pieces if piece not in ids]
        ids.update(zip(rest, self._together(rest)))
        for word, own in parts.items():
            out[word] = ids[own[0]] if len(own) == 1 else b"".join([ids[piece] for piece in own])
        return out

    def _together(self, pieces: list[str]) -> list[bytes]:
        """Ids of simple pieces, encoded as one text and cut where its words end."""
        if not pieces:
            return []
        whole = self._tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        raw, of = np.array(whole.ids, "<u4").tobytes(), np.array(whole.word_ids, np.int64)
        cuts = (np.searchsorted(of, np.arange(len(pieces) + 1)) * 4).tolist()
        if of.size and of[-1] == len(pieces) - 1 and all(a < b for a, b in pairwise(cuts)):
            return [raw[a:b] for a, b in pairwise(cuts)]
        return [self._alone(piece) for piece in pieces]

    def _piece(self, piece: str) -> bytes:
        """Ids of a simple piece of ASCII or Latin-1, from the merges themselves.

        Such a piece is in normal form, and the same letter by letter in lower case.
        """
        small = piece.lower()
        small = small if small.isascii() else small.encode().decode("latin-1").translate(_BYTES)
        ids = [token.id for token in self._model.tokenize(small)]
        return pack(f"<{len(ids)}I", *ids)

    def _alone(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_made: dict[tuple[str, int], WordTokens] = {}


def word_tokens(path: str, remember: int) -> WordTokens:
    """The tokenizer of this Python worker; its memory of words outlives a task."""
    if (path, remember) not in _made:
        place = path
        if not os.path.exists(path):
            import public_tokenizers

            place = public_tokenizers.path(path)
        _made[path, remember] = WordTokens(place, remember)
    return _made[path, remember]
