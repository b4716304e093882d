"""Byte-level BPE vocabularies: exact token counts at every prefix, and token ids.

The vocabulary file (``tokenizers`` JSON) is a parameter; it is never trained or copied here.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import accumulate

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# The pre-tokeniser's pattern of byte-level BPE, and its contractions.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTION = r"'(?:s|t|re|ve|m|ll|d)"

#: A unit is a run of white space with what follows it.  How a unit is cut into words never
#: depends on the text around it, and every prefix of a text is whole units and a prefix of one.
UNIT = regex.compile(rf"(?:\s*[^\S ])?{CONTRACTION}|\s*(?:\p{{L}}+|\p{{N}}+|[^\s\p{{L}}\p{{N}}]+)|\s+")
CONTRACTED = regex.compile(CONTRACTION)
KINDS = {"letter": regex.compile(r"\p{L}"), "number": regex.compile(r"\p{N}"), "space": regex.compile(r"\s")}
#: Characters for which the two libraries' Unicode tables cannot differ.
RARE = regex.compile("[^\\t\\n\\r\\x20-\\x7e\\u00a1-\\u00ff]")
#: Units remembered per worker; beyond it the memory is emptied and filled anew.  Longer units
#: than UNIT_KEPT characters are not remembered.
UNITS_KEPT, UNIT_KEPT = 1_000_000, 64
#: Token pairs remembered likewise.
PAIRS_KEPT = 1_000_000


def _byte_letters() -> dict[str, int]:
    """Letter → byte of the byte-level alphabet: printable bytes stand for themselves, the
    others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """One vocabulary in a worker: the library's tokenizer, its twin and the prefix tables."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        letters = _byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.library = Tokenizer.from_file(path)
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True))) or "(?!)")
        self.ids = {bytes(letters[x] for x in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.size = 1 + max([*self.ids.values(), *added.values()])
        self.longest = max(map(len, self.ids))
        self._spell = {b: c for c, b in letters.items()}
        self._fits: dict[tuple[bytes, bytes], bool] = {}
        self._steps: dict[str, bytes] = {}
        self._kinds: dict[str, str | None] = {}
        # The twin merges by id: right when every merge made the next id.
        merged = [self.ids[bytes(letters[x] for x in "".join(m.split(" ") if isinstance(m, str) else m))]
                  for m in spec["model"]["merges"]]
        self.twin = tiktoken.Encoding("twin", pat_str=PATTERN, mergeable_ranks=self.ids, special_tokens={}) \
            if merged == sorted(merged) and len(self.ids) == 256 + len(merged) else None

    # --- ids ---------------------------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        """Ids as the library gives them (no added begin or end), as uint32."""
        if self.twin is None or RARE.search(text) or self.special.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.twin.encode_to_numpy(text, disallowed_special=()), np.uint32)

    # --- prefix counts -----------------------------------------------------------------

    def _pair(self, left: bytes, right: bytes) -> bool:
        """Whether the library leaves the two tokens as they are when they stand together."""
        if len(self._fits) >= PAIRS_KEPT:
            self._fits.clear()
        spelt = ["".join(self._spell[b] for b in t) for t in (left, right) if t]
        known = [t.value for t in self.library.model.tokenize("".join(spelt))] == spelt
        self._fits[left, right] = known
        return known

    def word_counts(self, word: bytes) -> list[int]:
        """Token count of every prefix of one pre-token: entry i for its first i bytes.

        The last token of a prefix is the one suffix that is a token and may follow the last
        token of what stands before it; so count[i] = count[i - len(last)] + 1.
        """
        count, last = [0], [b""]
        ids, fits, longest = self.ids, self._fits, self.longest
        for end in range(1, len(word) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = word[start:end]
                if token in ids:
                    before = last[start]
                    fit = fits.get((before, token))
                    if fit is None:
                        fit = self._pair(before, token)
                    if fit:
                        count.append(count[start] + 1)
                        last.append(token)
                        break
            else:
                raise ValueError(f"no token ends the prefix {word[:end]!r}")
        return count

    def _words(self, *words: str) -> list[int]:
        """Counts after every character of words that are cut from each other."""
        out, base = [], 0
        for word in words:
            raw = word.encode()
            counts = self.word_counts(raw)
            if len(raw) > len(word):
                ends = accumulate(len(letter.encode()) for letter in word)
                counts = [0, *(counts[i] for i in ends)]
            out += [base + c for c in counts[1:]] if base else counts[1:]
            base += counts[-1]
        return out

    def unit_steps(self, unit: str) -> bytes:
        """Change of the token count with every character of a unit, as int8."""
        core = unit.lstrip()
        space = unit[:len(unit) - len(core)]
        if not space or not core or space == " ":
            counts = self._words(unit)
            if not space and len(core) > 2 and CONTRACTED.fullmatch(core):  # "'r" is two words, "'re" one
                counts[-2] = self._words(core[0], core[1])[-1]
        else:
            counts = self._words(space)          # a prefix that ends in the run has it as one word
            if space.endswith(" "):
                words = [space[:-1], " " + core]
            else:
                words = [space[:-1], space[-1], core] if len(space) > 1 else [space, core]
            after = self._words(*words)
            if len(core) > 2 and CONTRACTED.fullmatch(core):
                after[-2] = self._words(*words[:-1], core[0], core[1])[-1]
            counts += after[len(space):]
        found = bytes([(a - b) & 255 for a, b in zip(counts, [0, *counts])])
        if len(unit) <= UNIT_KEPT:
            if len(self._steps) >= UNITS_KEPT:
                self._steps.clear()
            self._steps[unit] = found
        return found

    def _kind(self, letter: str) -> str | None:
        """letter, number, space or other; None where the libraries' Unicode tables differ."""
        if letter not in self._kinds:
            own = next((k for k, pattern in KINDS.items() if pattern.match(letter)), "other")
            cut = self.library.pre_tokenizer.pre_tokenize_str
            real = next((k for k, before in (("letter", "a"), ("number", "1"), ("other", "!"))
                         if len(cut(before + letter)) == 1), "space")
            same = own == real and (own == "space") == letter.isspace()
            self._kinds[letter] = own if same else None
        return self._kinds[letter]

    def _encoded_steps(self, text: str) -> bytes:
        """Steps of a text from the library's own count of every prefix."""
        counts = [len(self.library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        return np.array([b - a for a, b in zip(counts, counts[1:])], np.int8).tobytes()

    def _plain_steps(self, text: str) -> bytes:
        known, new = self._steps.get, self.unit_steps
        if not RARE.search(text) or None not in map(self._kind, set(text)):
            return b"".join([known(u) or new(u) for u in UNIT.findall(text)])
        # A run of letters ends before anything else, whatever stands around: cut there, and
        # let the library count the pieces that hold a character the tables differ on.
        kinds = [self._kind(x) for x in text]
        cuts = [i for i in range(1, len(text)) if kinds[i - 1] == "letter" and kinds[i] not in ("letter", None)]
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(text)]):
            if None in kinds[a:b]:
                out.append(self._encoded_steps(text[a:b]))
            else:
                out += [known(u) or new(u) for u in UNIT.findall(text[a:b])]
        return b"".join(out)

    def steps(self, text: str) -> tuple[bytes, int]:
        """(change of the token count with every character, count of the whole text)."""
        parts, at = [], 0
        for hit in self.special.finditer(text):
            # Up to its last character a special string is ordinary text; with it, one token.
            before = np.frombuffer(self._plain_steps(text[at:hit.start()]), np.int8)
            run = np.frombuffer(self._plain_steps(text[at:hit.end() - 1]), np.int8)
            jump = int(before.sum(dtype=np.int64)) + 1 - int(run.sum(dtype=np.int64))
            parts += [run.tobytes(), np.int8(jump).tobytes()]
            at = hit.end()
        parts.append(self._plain_steps(text[at:]))
        steps = b"".join(parts)
        total = int(np.frombuffer(steps, np.int8).sum(dtype=np.int64))
        if RARE.search(text):                    # the library has the last word
            real = len(self.library.encode(text, add_special_tokens=False).ids)
            if real != total:
                steps, total = self._encoded_steps(text), real
        return steps, total


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The worker's copy of a vocabulary."""
    return Vocabulary(path)
