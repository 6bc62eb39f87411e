"""Secrets by patterns and by novelty: how many bytes a string adds to what a dictionary-primed zstandard knows.

Three plain patterns give the base spans. Beyond them, each long string on the line of a sensitive word, or on the lines
next to it, and the body of each private key block as a whole, is compressed with a raw
dictionary of the identifiers that code and configuration share and of the text around it. Ordinary words, paths and
names that the surroundings repeat cost few bytes; those are reported that cost nearly as many as a random string of
their own alphabet and length. A short string of letters alone costs all its bytes even where it is a word, so those
must also have letter pairs that words like the surrounding ones don't explain.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections import Counter
from collections.abc import Callable, Iterable
from math import log2

from pyspark.sql import DataFrame

from billweave.llm.common import BATCH_BYTES, map_batches

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Words whose neighbourhood is sensitive; also what an assignment needs.
ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE = re.compile(
    r"(?ai:password|passwd|secret|token|api[\x20_-]?key|credential|private[\x20_-]?key|bearer|AKIA|signature"
    r"|(?<![a-z])o?auth(?:ori[sz]ation|entication)?(?![a-z]))|[aA]uth(?=[A-Z])"
)
#: A sensitive word up to the value that is assigned to it; in headers ``bearer`` stands before the value itself.
NAMES_VALUE = re.compile(rf"""(?:(?:{SENSITIVE.pattern})[A-Za-z0-9_-]{{0,32}}["']?[\x20\t]*[:=]|\b(?ai:bearer))[\x20\t]*["']?\Z""")
#: A string that may be secret; an equals sign inside begins a new one.
RUN = re.compile(r"[A-Za-z0-9+/_-]+=*")
RUN_SIGN = re.compile("[A-Za-z0-9+/_-]")
#: A private key block, up to its END line or as far as its lines look like one.
BLOCK = re.compile(
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----"
    r"((?:(?!-----BEGIN)[\s\S])*?(?=-----END [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----)|(?:[ \t]*(?:\r?\n|\\[nr])+[ \t]*[A-Za-z0-9+/=]+(?=[ \t\r]*(?:\n|\\[nr]|\Z)))*)"
)
#: Lines before the body of an encrypted block.
BLOCK_HEADER = re.compile(r"(?m)^[ \t]*[A-Za-z-]+: .*$")
#: Common words of several languages, whose letter pairs stand for those of words.
COMMON = """
the and that have for not with you this but from they say her she will one all would there their what about which when
make can like time just know take people into year your good some could them see other than then now look only come its
over think also back after use two how our work first well way even new want because any these give day most information
university internationalization development characteristics responsibility environment understanding representation
der die und den von das mit sich des auf ist nicht eine als auch werden aus hat dass sie nach wird bei einer noch wie ein
wissenschaft gesellschaft verantwortung möglichkeit entwicklung geschwindigkeit schwierigkeiten zusammenarbeit
les des est que une dans qui par pour pas sur sont avec plus ce il au leur nous mais elle tout cette développement
connaissance gouvernement naturellement que los las por con una para del como está pero sus más este porque cuando
también conocimiento responsabilidad universidad desarrollo che non per della sono questo anche come nel alla più
"""
#: Fixed identifiers that prime the dictionary.
IDENTIFIERS = """
password passwd secret token api_key apikey access_key secret_key private_key public_key client_id client_secret
authorization bearer basic credential credentials username user login session cookie signature certificate config
settings environment production staging development default example localhost http https www com org net index html
http://www.example.com/ https://api.example.com/v1/ Content-Type application/json charset=utf-8 text/plain
import from return function class public static void string integer boolean null true false self this const let var
ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 00000000000000000000 xxxxxxxxxxxxxxxxxxxx
"""
#: Alphabets of random strings, small ones first: digits, hexadecimal, letters, base32, base36, base58 to base64.
_LOWER, _UPPER = string.ascii_lowercase, string.ascii_uppercase
ALPHABETS = (
    string.digits, string.digits + "abcdef", string.digits + "ABCDEF", string.hexdigits, _LOWER, _UPPER, _LOWER + "234567",
    _UPPER + "234567", _LOWER + string.digits, _UPPER + string.digits, _LOWER + _UPPER, _LOWER + _UPPER + string.digits,
)
DIGESTS = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str, lowered: str) -> list[Span]:
    spans = []
    if any(word in lowered for word in ASSIGNED):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    # Runs are maximal, so asking for 24 at once drops the same runs as asking afterwards.
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def card_number(digits: str) -> bool:
    """Whether digits have the length and the check digit (Luhn) of a payment card's number."""
    doubled = [int(d) if k % 2 == 0 else int(d) * 2 - 9 * (d > "4") for k, d in enumerate(reversed(digits))]
    return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def letter_pairs(text: str) -> Counter[str]:
    """Counts of the pairs of ASCII letters next to each other, whatever their case."""
    return Counter(w[k : k + 2] for w in re.findall("[a-z]+", text.lower()) for k in range(len(w) - 1))


class Novelty:
    """Marginal compressed bytes of a string against identifiers and surroundings."""

    def __init__(self, around: int = 600, near: int = 48, least: float = 0.8, shortest: int = 16):
        import zstandard

        self.zstd, self.around, self.near, self.least, self.shortest = zstandard, around, near, least, shortest
        self.identifiers = IDENTIFIERS.encode()
        self.random_costs: dict[tuple[str, int], float] = {}
        self.pairs = letter_pairs(IDENTIFIERS + COMMON)

    def bytes_added(self, candidate: str, surroundings: str) -> int:
        primer = self.zstd.ZstdCompressionDict(self.identifiers + surroundings.encode(), dict_type=self.zstd.DICT_TYPE_RAWCONTENT)
        squeeze = self.zstd.ZstdCompressor(
            level=12, dict_data=primer, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress
        return len(squeeze(candidate.encode())) - len(squeeze(b""))

    def random_bytes(self, candidate: str, most: int = 2048) -> float:
        """Bytes that random strings of the candidate's alphabet and length add; beyond ``most`` characters in proportion.

        Signs between letters and digits, as in identifiers that are written in groups, don't widen the alphabet.
        """
        used, n = set(re.sub("[^A-Za-z0-9]", "", candidate)), min(len(candidate), most)
        alphabet = next(a for a in ALPHABETS if used <= set(a))
        if (alphabet, n) not in self.random_costs:
            rng = random.Random(n)
            made = [self.bytes_added("".join(rng.choices(alphabet, k=n)), "") for _ in range(3)]
            self.random_costs[alphabet, n] = sum(made) / len(made)
        return self.random_costs[alphabet, n] * len(candidate) / n

    def wordlike(self, candidate: str, around: str) -> bool:
        """Whether the pairs of known and surrounding words tell the letters better than chance (1 in 26) does."""
        near, own = letter_pairs(around), letter_pairs(candidate)
        firsts: Counter[str] = Counter()
        for pairs in (self.pairs, near):
            for pair, n in pairs.items():
                firsts[pair[0]] += n
        bits = sum(n * log2((firsts[p[0]] + 13) / (self.pairs[p] + near[p] + 0.5)) for p, n in own.items())
        return bits < log2(26) * own.total()

    def novel(self, candidate: str, around: str) -> bool:
        """Letters alone must not be words."""
        if self.bytes_added(candidate, around) < self.least * self.random_bytes(candidate):
            return False
        return bool(re.search("[0-9]", candidate)) or not self.wordlike(candidate, around)

    def secret_number(self, text: str, start: int, end: int) -> bool:
        """Digits alone are personal or business data, unless a sensitive word names them as its value and they have
        ``shortest`` unbroken digits and aren't a card's."""
        digits = re.findall("[0-9]+", text[start:end])
        if max(map(len, digits), default=0) < self.shortest or card_number("".join(digits)):
            return False
        return bool(NAMES_VALUE.search(text[max(0, start - 80) : start]))

    def contexts(self, text: str) -> Iterable[tuple[int, int]]:
        """Stretches that are sensitive: the lines of sensitive words with the line before and after, merged."""
        low = high = line_end = -1
        for word in SENSITIVE.finditer(text):
            if word.end() <= line_end:
                if word.end() + self.near > high:
                    high = min(len(text), word.end() + self.near)
                continue
            before = text.rfind("\n", 0, word.start())
            start = text.rfind("\n", 0, before) + 1 if before > 0 else 0
            line_end = text.find("\n", word.end()) % (len(text) + 1)
            after = text.find("\n", line_end + 1) % (len(text) + 1)
            start, end = min(start, max(0, word.start() - self.near)), min(len(text), max(after, word.end() + self.near))
            if start > high:
                if high >= 0:
                    yield low, high
                low, high = start, end
            else:
                low, high = min(low, start), max(high, end)
        if high >= 0:
            yield low, high

    def around_of(self, text: str, start: int, end: int) -> str:
        return text[max(0, start - self.around) : start] + text[end : end + self.around]

    def blocks(self, text: str) -> list[Span]:
        """Bodies of private key blocks, each measured without its line breaks."""
        found = []
        for block in BLOCK.finditer(text) if "PRIVATE KEY" in text else ():
            # Headers are blanked, so places stay.
            body = BLOCK_HEADER.sub(lambda m: " " * len(m[0]), block[1])
            runs = list(re.finditer(r"(?<!\\)[A-Za-z0-9+/=]+", body))
            whole = "".join(r[0] for r in runs)
            if len(whole) >= self.shortest:
                start, end = block.start(1) + runs[0].start(), block.start(1) + runs[-1].end()
                if self.novel(whole, self.around_of(text, start, end)):
                    found.append((start, 3, end))
        return found

    def spans(self, text: str) -> list[Span]:
        found, done = self.blocks(text), 0
        held = list(found)
        for low, high in self.contexts(text):
            while low and RUN_SIGN.match(text, low - 1):  # whole runs, also where they leave the neighbourhood
                low -= 1
            for begin in RUN.finditer(text, max(low, done), max(high, done)):
                run = RUN.match(text, begin.start())
                if run.start() < done:
                    continue
                done = run.end()
                if len(run[0]) < self.shortest or any(s < done and run.start() < e for s, _, e in held):
                    continue
                # A key may be written onto its word; what follows the word counts for itself where the whole isn't novel.
                for start in (run.start(), *(w.end() for w in SENSITIVE.finditer(text, run.start(), done))):
                    lettered = re.search("[A-Za-z]", text[start:done]) or self.secret_number(text, start, done)
                    if done - start >= self.shortest and lettered and self.novel(text[start:done], self.around_of(text, start, done)):
                        found.append((start, 3, done))
                        break
        return sorted(found)


def secret_spans(text: str, novelty: Novelty) -> list[Span]:
    """All spans by start, then kind: those of the patterns, and novel strings that none of them covers."""
    lowered = text.lower()
    base = base_spans(text, lowered)
    novel = novelty.spans(text) if SENSITIVE.search(text) else []
    return sorted(base + [s for s in novel if not any(b[0] < s[2] and s[0] < b[2] for b in base)])


def listed(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs(doc_id, text)``; null and empty texts have no spans. Spans count code points."""

    def make() -> Callable[[dict], Iterable[dict]]:
        novelty = Novelty()

        def step(batch: dict) -> Iterable[dict]:
            every = [secret_spans(text or "", novelty) for text in batch["text"]]
            base = [[s for s in spans if s[1] < 3] for spans in every]
            yield {"doc_id": batch["doc_id"]} | {
                f"n_{kind}": [sum(s[1] == k for s in spans) for spans in base] for k, kind in enumerate(KINDS[:3])
            } | {
                "base_sha256": [hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base],
                "spans": [listed(spans) for spans in every],
            }

        return step

    return map_batches(docs.select("doc_id", "text"), make, DIGESTS)


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each secret replaced by its kind; of an assignment, only the value."""
    out, at = [], 0
    for start, kind, end in spans:
        if kind == 0:
            start = max(ASSIGN.match(text, start, end).start(2), at)
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; other columns and null texts stay. Batches are bounded by their bytes."""
    columns = docs.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def make() -> Callable[[dict], Iterable[dict]]:
        novelty = Novelty()

        def step(batch: dict) -> Iterable[dict]:
            out = {c: batch[c] for c in columns}
            out["text"] = [t and redacted(t, secret_spans(t, novelty)) for t in batch["text"]]
            yield out

        return step

    return map_batches(docs, make, ddl, BATCH_BYTES)
