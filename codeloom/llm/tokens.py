"""Token ids of a byte-level BPE vocabulary file, per task."""

from __future__ import annotations

import json
import re

import numpy as np

# How byte-level BPE splits text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The rank encoder's pattern search panics on runs of white space from about 986,000 characters; longer ones than this are not given to it.
LONGEST_RUN = 100_000

_SPACES = re.compile(r"\s+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of_symbol() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others, in order, as the letters from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Encodes whole texts as ``Tokenizer.encode(text, add_special_tokens=False)`` does: added tokens in a text are their ids.

    With ``special_as_text``, strings of special tokens in a text are ordinary text; added tokens that are not special stay tokens.

    If ids rise in the order of the merges, as in most byte-level vocabularies, ids are ranks and the ids are found by ranks,
    which takes a third of the time of the general encoder and gives the same ids. Else the general encoder is used, as for texts
    with more than LONGEST_RUN characters of white space in a row.
    """

    def __init__(self, file_text: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        model = json.loads(file_text)
        self.general = Tokenizer.from_str(file_text)
        self.general.encode_special_tokens = special_as_text
        self.by_rank = None
        added = {t["content"]: t for t in model.get("added_tokens") or () if t["content"]}
        cut = {c: t["id"] for c, t in added.items() if not (special_as_text and t.get("special"))}
        # Of added tokens that begin at one place, the longest counts.
        self.added = cut
        self.cuts = re.compile("(" + "|".join(re.escape(c) for c in sorted(cut, key=len, reverse=True)) + ")") if cut else None
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        plain = model.get("normalizer") is None and (model.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        plain = plain and not model["pre_tokenizer"].get("add_prefix_space")
        # The library looks for added tokens kind by kind; the rank path knows one kind without conditions on what stands around it.
        plain = plain and len({(bool(t.get("normalized")), bool(t.get("special"))) for t in added.values()}) <= 1
        plain = plain and not any(t.get(flag) for t in added.values() for flag in ("single_word", "lstrip", "rstrip"))
        if plain and all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs)):
            import tiktoken

            symbol = byte_of_symbol()
            ranks = {bytes(symbol[c] for c in token): i for token, i in vocabulary.items() if token not in added}
            self.by_rank = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if self.by_rank is None or (len(text) > LONGEST_RUN and any(m.end() - m.start() > LONGEST_RUN for m in _SPACES.finditer(text))):
            return np.array(self.general.encode(text, add_special_tokens=False).ids, "<u4")
        if self.cuts is None or not self.cuts.search(text):
            return np.array(self.by_rank.encode_ordinary(text), "<u4")
        ids: list[int] = []
        # Every other part is an added token; the parts between them are encoded on their own.
        for n, part in enumerate(self.cuts.split(text)):
            ids += [self.added[part]] if n % 2 else self.by_rank.encode_ordinary(part)
        return np.array(ids, "<u4")
