"""BPE by a tokenization automaton: compile the merges, encode by transitions, decode by labels.

The automaton reads tokens.  It starts as one state with a loop for every base symbol; each merge
(u, v) -> w then adds one gadget: the state entered by u is replaced by a copy without its v-arc,
and w-arcs lead wherever v-arcs led.  After the last gadget the paths are exactly the sequences
that the merges leave, one path per string, so the state after a token says which tokens may
follow.  States are kept as copies of an older state minus one arc, not as 49,000 arc lists.

Encoding a pre-split word runs over its bytes, one transition each, without backing out: a prefix is
a state, and the last token of every prefix is determined.  Transitions are compiled on first use,
once for all words that share a prefix: the token that ends there is the one whose arc leaves the state of
the prefix before it.  Reading the last tokens from the end back spells the word's path; words read
lately are looked up.  Words, transitions and arcs are held in bounded numbers, because an executor's
Python workers share its memory.  Decoding emits the labels of the arcs.

Defined results: null counts as empty text; empty text has no tokens and decodes to empty text;
the literal special tokens inside a text become their ids, as in the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from roomtide.llm.names import unused

# Fixed value: the pattern that splits text into words in the tokenizer file this module reads.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "\n"
# Fixed value: white space as the library's regular expressions understand it.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters and numbers that Unicode 17.0 adds.  The pattern's package knows them, the
# library (16.0) takes them for symbols.
UNKNOWN = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF
10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686
16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191
191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE
1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479
3D000-3FC3F
"""
# Capitals that Unicode 16.0 and 17.0 add, by their small letters; the library lowers them.
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
         0xA7DA: 0xA7DB, 0xA7DC: 0x19B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
         **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}


def ranges(listed: str) -> list[tuple[str, str]]:
    """First and last code point of every range of a list in hexadecimal."""
    return [(r.partition("-")[0], r.rpartition("-")[2]) for r in listed.split()]


def char_class(listed: str) -> str:
    """The ranges of a list in hexadecimal as the inside of a character class."""
    return "".join(f"\\U{int(a, 16):08x}-\\U{int(b, 16):08x}" for a, b in ranges(listed))


def word_pattern(full: bool) -> str:
    """WORD_PATTERN as the library reads it; not ``full``: for texts below the first unknown letter."""
    pattern = WORD_PATTERN.replace(r"[^\s", "[^" + BLANK)
    if not full:
        return pattern
    unknown = char_class(UNKNOWN)
    for kind in ("L", "N"):
        pattern = pattern.replace(rf"|[\p{{{kind}}}]", rf"|[\p{{{kind}}}--[{unknown}]]").replace(
            rf"|\p{{{kind}}}", rf"|[\p{{{kind}}}--[{unknown}]]")
    head, _, symbols = pattern.rpartition("|")
    return f"(?V1){head}|[{symbols[:-1]}||[{unknown}]]+"

#: The row of every state that no transition leaves yet.
NO_ROW: dict[str, int] = {}


def byte_symbols() -> list[str]:
    """Printable stand-in for every byte: itself if visible in Latin-1, else 256, 257, ..."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 255 and b != 173:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class Automaton:
    """States and arcs of the merges.

    ``parts[w]`` are the two arcs that merge w joins (None for base symbols), ``born[w]`` the step
    that adds w-arcs, ``cut[(u, v)]`` the step whose gadget removes v-arcs after u.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        made = {u + v for u, v in merges}
        # The word end becomes one character that no byte stands for, so that it cannot be split.
        self.name = {w: w[0] + END if suffix and len(w) > 1 else w for w in vocabulary if w not in made}
        self.ids = {self.name[w]: vocabulary[w] for w in self.name}
        self.parts: dict[str, tuple[str, str]] = {}
        self.born: dict[str, int] = {}
        self.cut: dict[tuple[str, str], int] = {}
        self.known: dict[tuple[str, str], bool] = {}
        for step, (u, v) in enumerate(merges, 1):
            self.name[u + v] = self.name[u] + self.name[v]
            self.ids[self.name[u + v]] = vocabulary[u + v]
            self.gadget(step, self.name[u], self.name[v])
        self.known.clear()
        self.forget()
        # The one string of every token that states and arcs refer to.
        self.token = {w: w for w in self.ids}
        self.label = {str(i): w for w, i in vocabulary.items()}
        self.longest = max(map(len, self.ids), default=1)

    def gadget(self, step: int, u: str, v: str) -> None:
        """Add one merge, unless no path holds u before v any more."""
        if u + v in self.born or not self.follows(u, v):
            return
        self.cut[u, v] = step
        self.born[u + v], self.parts[u + v] = step, (u, v)

    def follows(self, left: str, right: str) -> bool:
        """Whether the state entered by ``left`` has a ``right``-arc.

        The state's ancestry is that of left's last part, that part's last part and so on, each
        in force from its own birth until the birth of the next; likewise the arc stems from
        right's first part.  The arc is missing if a gadget cut one of these pairs while both
        were in force.  A merge of u with itself cuts the arc before it adds its own, hence <=.
        """
        cut, born, parts = self.cut, self.born, self.parts
        a, a_until = left, 1 << 60
        while True:
            a_from = born.get(a, 0)
            b, b_until = right, 1 << 60
            while True:
                b_from = born.get(b, 0)
                step = cut.get((a, b))
                if step is not None and a_from < step < a_until and b_from < step <= b_until:
                    return False
                if b not in parts:
                    break
                b, b_until = parts[b][0], b_from
            if a not in parts:
                return True
            a, a_until = parts[a][1], a_from

    def arc(self, left: str, right: str) -> bool:
        """Compiled answer of :meth:`follows`."""
        found = self.known.get((left, right))
        if found is None:
            found = self.known[left, right] = self.follows(left, right)
        return found

    def forget(self) -> None:
        """Start the transition rows anew: state 0 is the empty prefix; ``last`` is the token that ends
        at a state, ``before`` the state a symbol earlier, ``back`` the one that token started from."""
        self.rows: list[dict[str, int]] = [NO_ROW]
        self.last: list[str] = [""]
        self.before: list[int] = [0]
        self.back: list[int] = [0]

    def compiled(self, state: int, text: str, end: int) -> int:
        """Add the transition of ``state`` by the symbol before ``end``; ``state`` has read the rest.

        One token only can end there: paths are unique and so are those of prefixes, so it is the
        token whose arc leaves the state entered by the last token of the prefix before it.
        """
        last, before, tokens, known = self.last, self.before, self.token.get, self.known
        node, found = state, ""
        for start in range(end - 1, max(end - self.longest, 0) - 1, -1):
            token = tokens(text[start:end])
            if token is not None:
                left = last[node]
                follows = start == 0 or left and known.get((left, token))
                if follows is None:
                    follows = self.arc(left, token)
                if follows:
                    found = token
                    break
            node = before[node]
        made = len(last)
        if self.rows[state] is NO_ROW:
            self.rows[state] = {}
        self.rows[state][text[end - 1]] = made
        self.rows.append(NO_ROW)
        last.append(found)
        before.append(state)
        self.back.append(node)
        return made

    def path(self, text: str) -> list[str]:
        """Arc labels of the one path that spells the text: a transition for every symbol, then the
        last tokens from the end back."""
        rows, state, end = self.rows, 0, 0
        for symbol in text:
            end += 1
            after = rows[state].get(symbol)
            state = self.compiled(state, text, end) if after is None else after
        last, back = self.last, self.back
        out = []
        while state:
            out.append(last[state])
            state = back[state]
        return out[::-1]


class Tokenizer:
    """Splits, encodes and decodes as the file at ``path`` says (BPE with word ends)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        suffix = model["end_of_word_suffix"] or ""
        self.suffix = END if suffix else ""
        added = {t["content"] for t in spec["added_tokens"]}
        vocabulary = {w: i for w, i in model["vocab"].items() if w not in added}
        self.automaton = Automaton(vocabulary, merges, suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.automaton.label |= {str(i): t for t, i in self.special.items()}

    def parts(self) -> dict:
        """Plain attributes, as tasks receive them."""
        return vars(self) | {"automaton": vars(self.automaton)}

    @staticmethod
    def encoder(parts: dict) -> Encoder:
        """The process's encoder: its words outlive a task where Spark reuses the worker."""
        if "encoder" not in parts:
            automaton, tokenizer = Automaton.__new__(Automaton), Tokenizer.__new__(Tokenizer)
            vars(automaton).update(parts["automaton"])
            vars(tokenizer).update(parts, automaton=automaton)
            parts["encoder"] = Encoder(tokenizer)
        return parts["encoder"]


class Recent(dict):
    """Word -> what ``read`` makes of it; words of up to ``longest`` characters are read once, then
    looked up.  At most ``most`` words are held, and as many of before: those found there move over,
    the rest goes when the next ``most`` words are full."""

    most = 250_000
    longest = 64

    def __init__(self) -> None:
        super().__init__()
        self.older: dict = {}

    def __missing__(self, word: str):
        if len(word) > self.longest:
            return self.read(word)
        out = self.older.pop(word, None)
        if out is None:
            out = self.read(word)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out


class Encoder(Recent):
    """word -> its ids as decimal text; at most ``states`` transitions and ``arcs`` answers are held
    besides the words (transitions: and those of one word more)."""

    states = 50_000
    arcs = 200_000

    def __init__(self, tokenizer: Tokenizer) -> None:
        super().__init__()
        self.tokenizer = tokenizer
        self.symbols = byte_symbols()
        self.texts = {w: str(i) for w, i in tokenizer.automaton.ids.items()}
        self.words = regex.compile(word_pattern(False)).findall
        self.all_words = regex.compile(word_pattern(True)).findall
        self.first_unknown = chr(int(ranges(UNKNOWN)[0][0], 16))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, tokenizer.special)) + ")").split

    def read(self, word: str) -> str:
        """Run the automaton over the word; transitions of long words are not kept."""
        automaton = self.tokenizer.automaton
        word_text = word
        if not (word.isascii() and word.isprintable()):
            word_text = "".join([self.symbols[b] for b in word.encode("utf-8")])
        if len(automaton.last) > self.states or len(word) > self.longest:
            automaton.forget()
        if len(automaton.known) > self.arcs:
            automaton.known.clear()
        out = " ".join([self.texts[t] for t in automaton.path(word_text + self.tokenizer.suffix)])
        if len(word) > self.longest:
            automaton.forget()
        return out

    def encode(self, text: str) -> str:
        """Ids in decimal, joined by one space."""
        pieces = []
        for part in self.specials(text) if "<|" in text else (text,):
            if part in self.tokenizer.special:
                pieces.append(str(self.tokenizer.special[part]))
            elif part.isascii():
                pieces += map(self.__getitem__, self.words(part.lower()))
            else:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                part = part.lower()
                words = self.words
                if max(part) >= self.first_unknown:
                    part, words = part.translate(LOWER), self.all_words
                pieces += map(self.__getitem__, words(part))
        return " ".join(pieces)

    def decode(self, ids: str) -> str:
        """Labels of the arcs, joined by one space (the file names no other decoder)."""
        return " ".join(map(self.tokenizer.automaton.label.__getitem__, ids.split(" "))) if ids else ""


def encode(documents: DataFrame, path: str, texts: bool = False) -> DataFrame:
    """All columns but the text, plus n_tokens, ids_sha256 and decoded_sha256; with ``texts``
    also ``ids`` (array of int) and ``decoded``.

    The compiled automaton depends on the vocabulary file alone and is broadcast (a few MB).
    """
    shared = documents.sparkSession.sparkContext.broadcast(Tokenizer(path).parts())
    kept = [c for c in documents.columns
            if c not in ("text", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")]
    kinds = [f for f in documents.schema.fields if f.name in kept]
    read, = unused(kept, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Tokenizer.encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, firsts, seconds, ids, decoded = [], [], [], [], []
                for text in part.column(read).to_pylist():
                    line = encoder.encode(text or "")
                    back = encoder.decode(line)
                    counts.append(line.count(" ") + 1 if line else 0)
                    firsts.append(hashlib.sha256(line.encode()).hexdigest())
                    seconds.append(hashlib.sha256(back.encode()).hexdigest())
                    if texts:
                        ids.append([int(x) for x in line.split(" ")] if line else [])
                        decoded.append(back)
                out = [part.column(c) for c in kept] + [
                    pa.array(counts, pa.int64()), pa.array(firsts, pa.string()), pa.array(seconds, pa.string())]
                names = [*kept, "n_tokens", "ids_sha256", "decoded_sha256"]
                if texts:
                    out += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = StructType(kinds).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if texts:
        schema = schema.add("ids", ArrayType(IntegerType())).add("decoded", "string")
    source = documents.select(*kept, F.col("text").cast("string").alias(read))
    return source.mapInArrow(run, schema)
