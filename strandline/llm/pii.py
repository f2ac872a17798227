"""Personal data in text, plain and disguised, with spans in the characters of the source.

The base finds plain e-mail addresses, IPv4 addresses, card numbers and phone numbers.  A transducer then rewrites the text
into a plain form: look-alike letters and full-width forms become ASCII, invisible characters go, runs of spelled digits
become digits, and "at" and "dot" in their disguises become @ and a full stop.  It remembers for every output character the
source characters that it stands for, so a match in the plain form maps back to a span of the source.  A match is
added where a disguise takes part in it and it lies inside no base span of its kind; base spans stay, also those of a stump.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.llm.common import map_texts

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),  # a match can only begin where its digits do
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: What a text must hold for a kind to be possible: a cheap test before the pattern proper.
NEEDED = {"email": re.compile("@"), "ip": re.compile(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), "card": re.compile(r"(?:[0-9][\x20-]?){13}[0-9]"), "phone": re.compile(r"\+[0-9]")}
_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+\.[A-Za-z0-9-]")
_LOCAL, _DOMAIN = re.compile(r"[A-Za-z0-9._%+-]+"), re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Cyrillic and Greek letters that look like a Latin one, and signs that stand for @, full stop, plus and hyphen.
LOOKALIKES = dict(zip("аеорсухіјѕԁһӏАВЕКМНОРСТХІЈЅοανρικτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhlABEKMHOPCTXIJSoavpiktABEZHIKMNOPTYX")) | dict(zip("‐‑‒–—−․。․·＋﹢﹫", "------....++@"))
INVISIBLE = frozenset(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))
DIGITS = {w: str(k) for k, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_D = "(?a:" + "|".join(DIGITS) + ")"  # ASCII: a dotless i is no i
#: Ends of plainly written host names that make a bare "at" one of an address, and words after which it is none.
TOP_LEVEL = "com org net edu gov io info biz co uk us eu de fr es it nl be ch at pl se no dk fi ca au jp cn in br mx ru".split()
ARTICLES = "the a an this that these those my your our his her their its least last all home work".split()
#: Stands for a full stop that the first transducer made while the second one matches.
_MADE = "․"
#: White space before a sign, taken from its beginning, so that a long run is looked at once.
_BLANKS = r"(?:(?<!\s)\s+)?"
_MASKED = rf"(?:\s*[(\[{{<]\s*(?:dot|[.{_MADE}])\s*[)\]}}>]\s*|[ _]+dot[ _]+|{_MADE})"
_LABEL, _DOT = "[A-Za-z0-9-]+", rf"(?:{_MASKED}|\.)"
#: A host with a disguised dot may end in any label of letters; one with plain dots alone in a listed one.
_HOST = rf"(?:{_LABEL}(?:\.{_LABEL})*{_MASKED}(?:{_LABEL}{_DOT})*[A-Za-z]{{2,}}(?!-*[A-Za-z0-9])|{_LABEL}(?:{_DOT}{_LABEL})*?{_DOT}(?:{'|'.join(TOP_LEVEL)})(?![A-Za-z0-9]))"
_DISGUISES = re.compile(
    rf"(?P<digits>(?<![A-Za-z0-9]){_D}(?:[ \-,.{_MADE}]{{1,2}}{_D})*(?![A-Za-z0-9]))"
    rf"|(?P<at>{_BLANKS}[(\[{{<]\s*(?:at|@)\s*[)\]}}>]\s*|(?<=[A-Za-z0-9])[ _]+at[ _]+(?!(?:{'|'.join(ARTICLES)})\b)(?={_HOST})|(?<!\s)\s+@\s*(?={_HOST})|(?<=\S)@\s+(?={_HOST}))"
    rf"|(?P<dot>{_BLANKS}[(\[{{<]\s*(?:dot|[.{_MADE}])\s*[)\]}}>]\s*|(?<=[A-Za-z0-9])[ _]+dot[ _]+(?=[A-Za-z0-9]))"
    r"|(?P<plus>(?<![A-Za-z0-9])plus[ ]+(?=[0-9]|"
    rf"{_D}))",
    re.IGNORECASE,
)
#: Letters that stand for themselves in the first transducer: a text of these alone has no disguised letter.
_LETTERS = re.compile(r"[^\x00-\x7fÀ-ÿ]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in (x.lstrip("0") for x in found.split(".")))
    digits = re.sub("[^0-9]", "", found)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


def emails(text: str) -> list[tuple[int, int]]:
    """The leftmost matches of the e-mail pattern, found from each @ outwards: in linear time, however long a run of letters is."""
    out, at, begin = [], text.find("@"), 0
    while at >= 0:
        local, domain = _LOCAL.match(text[begin:at][::-1]), _DOMAIN.match(text, at + 1)
        if local and domain:
            out.append((at - local.end(), domain.end()))
        begin = domain.end() if local and domain else at + 1
        at = text.find("@", begin)
    return out


def base_spans(text: str, kinds=KINDS) -> list[tuple[str, int, int]]:
    """(kind, start, end) in characters: leftmost matches of each kind's pattern, failing ones dropped; by start, then kind."""
    out = []
    for kind in kinds:
        if not NEEDED[kind].search(text):
            continue
        if kind == "email":
            out += [(kind, a, b) for a, b in emails(text)] if _EMAIL_TAIL.search(text) else []
        else:
            out += [(kind, m.start(), m.end()) for m in PATTERNS[kind].finditer(text) if valid(kind, m[0])]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


class Tape:
    """Output of a transducer: characters, the source span of each, and whether a disguise made it."""

    def __init__(self):
        self.chars: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.disguised: list[bool] = []

    def put(self, char: str, start: int, end: int, disguised: bool) -> None:
        self.chars.append(char)
        self.spans.append((start, end))
        self.disguised.append(disguised)


def hinted(text: str) -> bool:
    """Whether a disguise is possible; the second transducer's own pattern decides, so that none is missed."""
    return bool(_LETTERS.search(text) or _DISGUISES.search(text))


def plain_letters(text: str) -> Tape:
    """First transducer: homoglyphs and compatibility forms to ASCII, invisible characters dropped."""
    tape, hidden = Tape(), False
    if text.isascii():
        tape.chars, tape.spans, tape.disguised = list(text), [(k, k + 1) for k in range(len(text))], [False] * len(text)
        return tape
    for k, c in enumerate(text):
        if c < "\x80":
            tape.put(c, k, k + 1, hidden)
        elif c in INVISIBLE:
            hidden = True
            continue
        else:
            d = LOOKALIKES.get(c)
            if d is None:
                d = unicodedata.normalize("NFKC", c)
                if len(d) != 1 or d >= "\x80":
                    v = unicodedata.decimal(c, None)
                    d = str(v) if v is not None else c
            tape.put(d, k, k + 1, d != c or hidden)
        hidden = False
    return tape


def undisguise(tape: Tape) -> Tape:
    """Second transducer: spelled digits, "at", "dot" and "plus" in their disguises."""
    text, out, at = "".join(_MADE if d and c == "." else c for c, d in zip(tape.chars, tape.disguised)), Tape(), 0

    def copy(to: int) -> None:
        out.chars += tape.chars[at:to]
        out.spans += tape.spans[at:to]
        out.disguised += tape.disguised[at:to]

    for m in _DISGUISES.finditer(text):
        copy(m.start())
        if m.lastgroup == "digits":
            for w in re.finditer("[A-Za-z]+", m[0]):
                a, b = m.start() + w.start(), m.start() + w.end()
                out.put(DIGITS[w[0].lower()], tape.spans[a][0], tape.spans[b - 1][1], True)
        else:
            out.put({"at": "@", "dot": ".", "plus": "+"}[m.lastgroup], tape.spans[m.start()][0], tape.spans[m.end() - 1][1], True)
        at = m.end()
    copy(len(text))
    return out


def find_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: those of the base and of disguised identifiers."""
    base = base_spans(text)
    if not hinted(text):
        return base, base
    tape = undisguise(plain_letters(text))
    if not any(tape.disguised):
        return base, base
    extra = []
    for kind, a, b in base_spans("".join(tape.chars)):
        start, end = tape.spans[a][0], tape.spans[b - 1][1]
        if any(tape.disguised[a:b]) and not any(k == kind and s <= start and end <= e for k, s, e in base):
            extra.append((kind, start, end))
    return base, sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame) -> DataFrame:
    """Every row of docs (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_disguised.

    spans lists kind:start:end in code points, end exclusive, by start, then kind.  A null or empty text has no spans (its
    base_sha256 is that of no bytes); repeated rows are read each; an empty table gives no rows; other columns are ignored.  A long text is read whole, in
    time linear in its length; spans that begin together are listed by kind.
    Rows are independent: nothing is shuffled.
    """
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_disguised"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            base, spans = find_spans(text or "")
            rows.append((*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), len(spans) - len(base)))
        types = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], names=names)

    return map_texts(docs.select("doc_id", "text"), step, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long")
