"""Ids of whole texts by a tokenizers file, word by word.

For a tokenizer that drops white space and never joins characters across it, the ids of a text are
those of its words one after another. So each worker keeps the ids of words it has seen, in bounded
memory, and only new words reach the tokenizer, many in one call. Which tokenizers are like that is
read from their file; others get whole texts.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import sys
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from lateline.llm.common import keep

#: The one use of white space that the memory of words relies on: it is dropped.
DROPPED_SPACE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Words in each of two generations of a worker's memory; a word takes about 200 bytes.
REMEMBERED = 300_000
#: Bytes of texts whose words are held at once; a text is never cut.
AT_ONCE = 4_000_000
#: Small letters (a-z and those of Latin-1, which have no parts to combine) and then signs other than the
#: apostrophe, if any: two runs that the pattern takes apart whatever they are.
LETTERS_SIGNS = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")
SEPARATOR = "0"
#: A sign between a letter and white space: a run of its own whatever the letter belongs to. The sign is looked for
#: first, which skips all else.
LAST_SIGN = re.compile(rb"[!,.:;?](?=[ \n])(?<=[a-z].)")


def _byte_names() -> dict[int, int]:
    """The character that stands for each byte that is none itself, in tokenizers of bytes."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {byte: 0x100 + i for i, byte in enumerate(b for b in range(256) if b not in plain)}


#: That of each byte, in their order.
SPELLING = "".join(chr(_byte_names().get(byte, byte)) for byte in range(256))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class TextIds:
    """``ids(texts)`` gives the ids of each UTF-8 text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            described = json.load(file)
            steps = described.get("pre_tokenizer") or {}
            normalizer, added = described.get("normalizer") or {}, described.get("added_tokens") or []
        first, *others = steps.get("pretokenizers") or [steps]
        kinds = [step["type"] for step in normalizer.get("normalizers") or [normalizer] if "type" in step]
        # Words are told apart as the pattern does it, letters are lowered, and special tokens all begin with "<|".
        self.by_word = first.get("pattern", {}).get("Regex") == DROPPED_SPACE and first.get("invert", False)
        self.by_word &= "Lowercase" in kinds and "NFC" in kinds and set(kinds) <= {"NFC", "Replace", "Lowercase"}
        self.by_word &= all(token["content"].startswith("<|") for token in added)
        # Then a run of letters is one word of the model, spelled in bytes.
        self.by_letters = self.by_word and [step["type"] for step in others] == ["ByteLevel"]
        self.by_letters &= not any(others[0].get(key) for key in ("add_prefix_space", "use_regex")) if others else False
        separator = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.separator = separator[0] if len(separator) == 1 else None
        self.forget()
        keep(self.forget)

    def forget(self) -> None:
        """Empty the memory of words."""
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, words: list[bytes]) -> None:
        """Ids of new words; of letters and signs together from those of both."""
        others, letters, split = [], [], []
        for word in words:
            if not (found := LETTERS_SIGNS.fullmatch(word)) or b"<|" in word:
                others.append(word)
            elif found[2]:
                split.append((word, *found.groups()))
            else:
                letters.append(word)
        letters += self._missing({first for _, first, _ in split} - set(letters))
        self._encode_letters(letters)
        self._encode(others + self._missing({signs for _, _, signs in split} - set(others)))
        for word, first, signs in split:
            self.new[word] = self.new[first] + self.new[signs]

    def _missing(self, words: set[bytes]) -> list[bytes]:
        """Those that are not known; what is known from before is made recent."""
        missing = []
        for word in words:
            if word not in self.new:
                if word in self.old:
                    self.new[word] = self.old[word]
                else:
                    missing.append(word)
        return missing

    def _encode_letters(self, words: list[bytes]) -> None:
        """Ids of runs of small letters: the model's own, without the way to it."""
        if not self.by_letters:
            return self._encode(words)
        tokenize = self.tokenizer.model.tokenize
        for word in words:
            ids = array("I", [token.id for token in tokenize(codecs.charmap_decode(word, "strict", SPELLING)[0])])
            if sys.byteorder == "big":
                ids.byteswap()
            self.new[word] = ids.tobytes()

    def _encode(self, words: list[bytes]) -> None:
        """Ids of words, from texts of many words with the separator between them."""
        plain = [w for w in words if b"0" not in w] if self.separator is not None else []
        known = set(plain)
        single = [w for w in words if w not in known]
        for word, ids in zip(single, self._whole(single)):
            self.new[word] = ids
        between = f" {SEPARATOR} "
        groups = [plain[i : i + 250] for i in range(0, len(plain), 250)]
        joined = [between.join(w.decode() for w in group) for group in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = (4 * np.flatnonzero(ids == self.separator)).tolist() + [4 * len(ids)]
            raw, start = ids.tobytes(), 0
            for word, end in zip(group, ends):
                self.new[word] = raw[start:end]
                start = end + 4

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._whole(texts)
        found, start = [], 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= AT_ONCE):
                size += len(texts[stop])
                stop += 1
            if len(self.new) > REMEMBERED:
                self.new, self.old = {}, self.new
            found += self._by_word([folded(t) for t in texts[start:stop]])
            start = stop
        return found

    def _by_word(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts whose words are few enough to hold: each different word is looked up once."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words = split.flatten().dictionary_encode()
        known = self._known(words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        place, order = np.cumsum(sizes) - sizes, words.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[order])])
        taken = np.repeat(place[order] - ends[:-1], sizes[order]) + np.arange(ends[-1])
        raw = np.frombuffer(b"".join(known), "<u4")[taken].tobytes()
        cuts = (4 * ends[split.offsets.to_numpy()]).tolist()
        return [raw[start:stop] for start, stop in zip(cuts, cuts[1:])]

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words, learned if they are new."""
        found = list(map(self.new.get, words))
        self._learn(self._missing({word for word, ids in zip(words, found) if ids is None}))
        return [self.new[word] if ids is None else ids for word, ids in zip(words, found)]


def folded(text: bytes) -> bytes:
    """Lower case for A-Z, and last signs apart from their word, where this can't change the ids: no special tokens,
    no combining marks. Fewer different words are left."""
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text
    return LAST_SIGN.sub(rb" \g<0>", text.lower())


@cache
def text_ids(path: str) -> TextIds:
    """One for each worker and file; its memory of words stays from task to task, until a task lets all go."""
    return TextIds(path)
