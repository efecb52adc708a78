"""Exact token ids by cached pre-tokens.

A byte-level BPE with the usual pre-token pattern never joins text across a single space
that stands between two non-space characters: the space opens the next pre-token.  So a
text can be cut there, and every piece (a word with its punctuation and leading space) has
the ids that the library gives it alone.  The same holds for a single line break between two
non-space characters, which is a pre-token of its own.  Pieces repeat a lot, so a table answers
most of them and only misses reach the library.
"""

from __future__ import annotations

import json
import os
import re

from vitrine.llm.common import slices

# every white space of any Unicode version the libraries use is also \s here
CUT = re.compile(r"(?<=\S)(?: (?=\S)|(?=\n\S))")
# a plain word with closing marks is two pre-tokens for sure, which the library's model takes without its text pipeline
PLAIN = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|]*)")


def _byte_letters() -> dict[int, str]:
    """The letters by which a byte-level vocabulary writes the bytes of the Latin letters in PLAIN."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


LETTERS = _byte_letters()
SPACE, BREAK = chr(256 + 32), chr(256 + 10)  # a space and a line break there


def load(vocabulary: str):
    """The tokenizer of a vocabulary file: a path, or the name of a public one."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    if "/" not in vocabulary:
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    return Tokenizer.from_file(str(vocabulary))


class Pieces:
    """Ids of texts by a table of known pieces (``seed``) and a cache that grows up to ``most`` entries.

    ``value`` turns the id list of a piece into what is kept (a count, or packed ids).
    Keys are pieces without their leading space (or with their leading line break); a text's first
    piece has neither and is kept apart.
    """

    def __init__(self, tokenizer, value, seed: dict | None = None, most: int = 1_200_000) -> None:
        self.tokenizer, self.value, self.seed, self.most = tokenizer, value, dict(seed or {}), most
        self.known = dict(self.seed)
        self.misses = self.lookups = 0
        kind = json.loads(tokenizer.to_str())
        split = kind.get("pre_tokenizer") or {}
        self.plain = kind.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")

    def encode(self, pieces: list[str]) -> list:
        if not self.plain:
            return [self.value(e.ids) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        tokenize, value, other = self.tokenizer.model.tokenize, self.value, []
        out: list = [None] * len(pieces)
        plain, tails = PLAIN.fullmatch, {}
        for i, piece in enumerate(pieces):
            m = plain(piece)
            if not m:
                other.append(i)
                continue
            before, word, marks = m.groups()
            if not word.isascii():
                word = word.translate(LETTERS)
            ids = [t.id for t in tokenize(SPACE + word if before == " " else word)]
            if before == "\n":
                ids = [t.id for t in tokenize(BREAK)] + ids
            if marks:
                if marks not in tails:
                    tails[marks] = [t.id for t in tokenize(marks)]
                ids += tails[marks]
            out[i] = value(ids)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([pieces[i] for i in other], add_special_tokens=False)):
            out[i] = value(e.ids)
        return out

    def of(self, texts: list[str]):
        """Per text the list of its pieces' values, in order."""
        for a, b in slices(texts):
            yield from self._some(texts[a:b])

    def _some(self, texts: list[str]) -> list[list]:
        if len(self.known) > self.most:
            self.known = dict(self.seed)
        get, out, holes, misses = self.known.get, [], [], {}
        for i, text in enumerate(texts):
            units = text.replace("\n", " \n").split(" ")
            values = list(map(get, units))
            values[0] = None
            for k in [k for k, v in enumerate(values) if v is None]:
                holes.append((i, k, units[k]))
            out.append(values)
            self.lookups += len(units)
        odd = set()
        for i, k, unit in holes:
            # an empty piece, or one with white space at an end, is none: such a text is cut with care
            if not unit or unit[-1].isspace() or (k and (unit[1] if unit[0] == "\n" else unit[0]).isspace()):
                if k or len(out[i]) > 1:
                    odd.add(i)
            elif k:
                misses[unit] = None
        self._learn(misses)
        self.misses += len(misses)
        heads = iter(self.encode([unit for _, k, unit in holes if not k]))
        for i, k, unit in holes:
            out[i][k] = get(unit) if k else next(heads)
        for i in odd:
            first, *rest = CUT.split(texts[i])
            self._learn(dict.fromkeys(u for u in rest if u not in self.known))
            out[i] = [*self.encode([first]), *map(get, rest)]
        return out

    def _learn(self, units: dict) -> None:
        self.known.update(zip(units, self.encode([u if u[0] == "\n" else " " + u for u in units])))
