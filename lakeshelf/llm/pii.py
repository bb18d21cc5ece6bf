"""Personal data by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns and are always kept.
Beside them, wider candidates are gathered in the gaps between base spans:
digit groups, written-out mail addresses, account numbers, names after a form of
address, secrets. Labelers vote on each candidate: regular expressions check its
form, gazetteers its words, context labelers the words around it; a labeler may
abstain. Spark counts the patterns of votes and clues (16 shapes, 32 hashes of the
word before) over all documents; there are at most about 140,000 of them, whatever
the corpus. Expectation-maximisation over these counts estimates each labeler's
reliability for each kind, and the posteriors train the final span classifier, a
logistic regression on votes and clues. Half of its training weight has the clues
alone, so that it judges spans by the text around them where labelers abstain.
Candidates that it accepts are added.

Text is scanned twice, without a join: once for the counts, once with the
trained classifier. Patterns are anchored so that no run of characters is
scanned more than a few times, however long the text is.

Defined cases: null or empty text has no spans; offsets count code points, the
end is exclusive; repeated rows get equal results; an empty table trains
nothing and gives no rows; without candidates only base spans are returned."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "number", "written_email", "account", "name", "secret")

# --- base spans -----------------------------------------------------------

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = str.maketrans("", "", " ().-+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """The local part is the run before each ``@``, from the end of the last
    match on; this is where a leftmost scan finds it, without rescanning."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        m = _AT.match(text, at)
        if m:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = m.end()
                out.append((start, done))
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), sorted by start, then kind as listed."""
    out = [(s, e, "email") for s, e in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            d = m[0].translate(_NOT_DIGIT)
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(m[0].translate(_NOT_DIGIT)) <= 15:
                    out.append((*m.span(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


# --- candidates and labelers ----------------------------------------------

#: Forms of address, first names and key words, as usually spelt in their languages.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Sir", "Herr", "Frau", "Monsieur", "Madame", "Mademoiselle", "Mme", "Mlle",
          "Señor", "Señora", "Señorita", "Sra", "Sr", "Don", "Doña")
FIRST_NAMES = frozenset((
    "Adam Alice Amy Andrea Andrew Angela Anna Anne Anthony Barbara Brian Carol Charles Christopher Daniel David Deborah Donna "
    "Edward Elizabeth Emily Emma Eric George Grace Hannah Helen Henry Jack Jacob James Jane Jason Jennifer Jessica John Joseph "
    "Karen Kevin Laura Linda Lisa Margaret Mark Mary Matthew Michael Nancy Nicole Olivia Patricia Paul Peter Rachel Rebecca "
    "Richard Robert Ruth Samuel Sarah Sophia Stephen Susan Thomas Timothy William "
    "Andreas Angelika Birgit Claudia Dieter Elke Ernst Franz Friedrich Fritz Hans Heike Heinrich Helga Ingrid Johannes Jürgen "
    "Karl Katrin Klaus Manfred Monika Petra Sabine Stefan Ursula Uwe Werner Wolfgang "
    "Antoine Camille Céline Chantal Claire François Françoise Gérard Hélène Isabelle Jacques Jean Julien Louis Lucie Marie Martin "
    "Mathieu Nathalie Nicolas Philippe Pierre Sophie Sylvie Thierry Véronique "
    "Alejandro Ana Antonio Carlos Carmen Cristina Diego Elena Fernando Francisco Isabel Javier José Juan Lucía Luis Manuel Maria "
    "María Miguel Pablo Pedro Pilar Rafael Rosa Sofía Teresa").split())
CALL_WORDS = ("call", "phone", "tel", "telephone", "mobile", "fax", "contact", "telefon", "anruf", "téléphone", "teléfono", "llamar")
CARD_WORDS = ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta", "payment")
ACCOUNT_WORDS = ("iban", "account", "konto", "compte", "cuenta", "ssn", "passport", "social")
SECRET_WORDS = ("token", "password", "passwd", "secret", "key", "apikey", "api_key", "access_key", "secret_key", "auth", "bearer",
                "passwort", "schlüssel", "clé", "contraseña", "clave")
MAIL_WORDS = ("mail", "email", "write", "contact", "reach")
NUMBER_WORDS = ("isbn", "version", "page", "figure", "order", "total", "price", "year", "section", "table", "item", "no",
                "commit", "revision", "checksum", "digest", "md5", "sha1", "sha256", "chapter", "invoice", "serial", "part")

_CANDIDATES = (
    ("number", re.compile(r"(?<![\w+.])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,18}(?![\w])")),
    ("account", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("secret", re.compile(r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]{0,63}[0-9])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])")),
)
#: A long value after "=" or ":", as keys are written.
_VALUE = re.compile(r"[=:] {0,2}[\"']?((?=[A-Za-z+/_-]{0,127}[0-9])[A-Za-z0-9+/_-]{20,128}={0,2})(?![A-Za-z0-9+/_=-])")
_WRITTEN = re.compile(r"(?<![\w.])[A-Za-z][A-Za-z0-9._]{0,63} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]{1,63})+")
_NAME = re.compile(r"(?<!\w)(?:" + "|".join(TITLES) + r")\.? ([A-ZÀ-Þ][a-zß-ÿ]{1,30}(?: [A-ZÀ-Þ][a-zß-ÿ]{1,30})?)(?!\w)")
_BEFORE = re.compile(r"\w+")
_HEX = re.compile(r"[0-9A-Fa-f]+")
_MIXED = re.compile(r"(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])(?=[^0-9]*[0-9])")
_CLASSES = tuple(map(re.compile, ("[0-9]", "[A-Z]", "[a-z]", "[^0-9A-Za-z]")))


def _mod97(s: str) -> bool:
    s = s.replace(" ", "")
    s = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def _secrets(text: str, lo: int, hi: int) -> list[tuple[int, int, str]]:
    """Hexadecimal runs, then long values that touch none of them."""
    hexes = [m.span() for m in _CANDIDATES[2][1].finditer(text, lo, hi)]
    out, i = list(hexes), 0
    for m in _VALUE.finditer(text, lo, hi):
        s, e = m.span(1)
        while i < len(hexes) and hexes[i][1] <= s:
            i += 1
        if i == len(hexes) or hexes[i][0] >= e:
            out.append((s, e))
    return [(s, e, "secret") for s, e in sorted(out)]


def gaps(length: int, taken) -> list[tuple[int, int]]:
    """What spans (start, end, ...), sorted by start, leave of a text."""
    out, at = [], 0
    for s, e, *_ in taken:
        if s > at:
            out.append((at, s))
        at = max(at, e)
    return out + [(at, length)] if at < length else out


def candidates(text: str, lo: int = 0, hi: int | None = None) -> list[tuple[int, int, str]]:
    """Wider spans between two places, leftmost and non-overlapping for each
    kind; what stands before ``lo`` still counts as the character before."""
    hi = len(text) if hi is None else hi
    out = []
    if _DIGIT.search(text, lo, hi):
        for kind, p in _CANDIDATES[:2]:
            out += [(*m.span(), kind) for m in p.finditer(text, lo, hi)]
        out += _secrets(text, lo, hi)
    if text.find("at)", lo, hi) >= 0 or text.find("at]", lo, hi) >= 0:
        out += [(*m.span(), "written_email") for m in _WRITTEN.finditer(text, lo, hi)]
    for m in _NAME.finditer(text, lo, hi):
        out.append((*m.span(1), "name"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


#: Votes: 1 personal, 0 not, -1 abstains.
LABELERS = ("form", "checksum", "grouping", "gazetteer", "context_for", "context_against", "neighbours")
_FOR = {"number": CALL_WORDS + CARD_WORDS + ACCOUNT_WORDS, "written_email": MAIL_WORDS, "account": ACCOUNT_WORDS,
        "name": CALL_WORDS + MAIL_WORDS, "secret": SECRET_WORDS}


def _before(text: str, start: int) -> list[str]:
    return [w.lower() for w in _BEFORE.findall(text[max(0, start - 40):start])][-4:]


def votes(text: str, start: int, end: int, kind: str, lo: int = 0, hi: int | None = None) -> tuple[int, ...]:
    """The labelers' votes on a candidate of the gap from ``lo`` to ``hi``, in
    the order of LABELERS."""
    s = text[start:end]
    digits = s.translate(_NOT_DIGIT)
    before = _before(text, start)
    form = checksum = grouping = gaz = -1
    if kind == "number":
        n = len(digits)
        form = 1 if 9 <= n <= 11 or 14 <= n <= 16 or (s[0] == "+" and 10 <= n <= 15) else 0
        checksum = 1 if 14 <= n <= 19 and luhn(digits) else (0 if n >= 14 else -1)
        grouping = 1 if re.fullmatch(r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|(?:[0-9]{4}[ -]){3}[0-9]{4}", s) else 0
    elif kind == "account":
        form, checksum = 1, int(_mod97(s))
    elif kind == "secret":
        form = 1 if (len(s) in (32, 40, 64) if _HEX.fullmatch(s) else _MIXED.match(s)) else 0
        grouping = 1 if len(set(s)) >= 10 else 0
    elif kind == "written_email":
        form = 1
    elif kind == "name":
        parts = s.split()
        form = 1 if len(parts) == 2 else 0
        gaz = 1 if parts[0] in FIRST_NAMES else -1
    ctx = 1 if any(w in _FOR[kind] for w in before) else -1
    against = 0 if any(w in NUMBER_WORDS for w in before) else -1
    around = text[max(lo, start - 3):start] + text[end:min(len(text) if hi is None else hi, end + 3)]
    near = 1 if '"' in around or ":" in around or "=" in around else (0 if re.search(r"[0-9$%]", around) else -1)
    return form, checksum, grouping, gaz, ctx, against, near


SHAPES, CLUE_WORDS = 16, 32


def clues(text: str, start: int, end: int) -> tuple[int, int]:
    """(the kinds of characters in a span as bits, a hash of the word before
    it or 0)."""
    span, before = text[start:end], _before(text, start)
    shape = sum(1 << i for i, p in enumerate(_CLASSES) if p.search(span))
    return shape, 1 + zlib.crc32(before[-1].encode(errors="replace")) % (CLUE_WORDS - 1) if before else 0


def judged(text: str, base: list[tuple[int, int, str]]):
    """(start, end, pattern) of each candidate in the gaps between base spans;
    a pattern is (kind, shape, word, votes)."""
    for lo, hi in gaps(len(text), base):
        if hi - lo < 3:
            continue  # shorter than any candidate
        for s, e, kind in candidates(text, lo, hi):
            yield s, e, (kind, *clues(text, s, e), votes(text, s, e, kind, lo, hi))


# --- reliabilities and classifier -----------------------------------------

ADDED_KINDS = KINDS[len(BASE_KINDS):]
_VOTED = 1 + len(ADDED_KINDS)
_CLUED = _VOTED + len(ADDED_KINDS) * len(LABELERS) * 2
N_FEATURES = _CLUED + SHAPES + CLUE_WORDS


@dataclass
class Model:
    """``accuracy`` of each kind's labelers (probability that a vote is right),
    ``prior`` by kind, and the classifier's weights over (bias, kinds, votes by
    kind, shapes, words before)."""
    accuracy: dict[str, np.ndarray] = field(default_factory=dict)
    prior: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def accepts(self, pattern: tuple) -> bool:
        return bool(len(self.weights)) and sum(self.weights[c] for c in columns(pattern)) >= 0


def columns(pattern: tuple, with_votes: bool = True) -> list[int]:
    """The features of a pattern that are 1."""
    kind, shape, word, v = pattern
    k = ADDED_KINDS.index(kind)
    out = [0, 1 + k, _CLUED + shape, _CLUED + SHAPES + word]
    if with_votes:
        out += [_VOTED + (k * len(LABELERS) + j) * 2 + 1 - x for j, x in enumerate(v) if x >= 0]
    return out


def reliabilities(v: np.ndarray, w: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over the vote patterns of one kind: (accuracy of each labeler, prior,
    posterior of each pattern). A vote is right with probability ``accuracy``,
    an abstention says nothing. The start (0.8) breaks the symmetry in favour of
    the labelers."""
    yes, no = v == 1, v == 0
    acc, prior = np.full(len(LABELERS), 0.8), 0.5
    for _ in range(rounds):
        log1 = np.log(prior) + yes @ np.log(acc) + no @ np.log(1 - acc)
        log0 = np.log(1 - prior) + yes @ np.log(1 - acc) + no @ np.log(acc)
        post = 1 / (1 + np.exp(np.clip(log0 - log1, -50, 50)))
        right = (w * post) @ yes + (w * (1 - post)) @ no
        cast = w @ (yes | no)
        acc = np.clip((right + 8) / (cast + 10), 0.55, 0.99)
        prior = float(np.clip((w @ post + 1) / (w.sum() + 2), 0.05, 0.95))
    return acc, prior, post


def fit(patterns: list[tuple], counts: np.ndarray) -> Model:
    """EM for each kind, then a logistic regression on the posteriors, with
    each pattern once with its votes and once with its clues alone. Kinds weigh
    alike, however often they occur."""
    model = Model()
    if not len(patterns):
        return model
    w, post = counts.astype(float), np.zeros(len(patterns))
    kinds = np.array([p[0] for p in patterns])
    weight = np.zeros(len(patterns))
    for kind in sorted({p[0] for p in patterns}):
        at = np.flatnonzero(kinds == kind)
        v = np.array([patterns[i][3] for i in at])
        model.accuracy[kind], model.prior[kind], post[at] = reliabilities(v, w[at])
        weight[at] = w[at] / w[at].sum()
    x = np.zeros((2 * len(patterns), N_FEATURES), dtype=np.float32)
    for i, p in enumerate(patterns):
        x[i, columns(p)] = 1
        x[len(patterns) + i, columns(p, with_votes=False)] = 1
    ws, target = np.tile(weight / (2 * weight.sum()), 2), np.tile(post, 2)
    theta, ridge = np.zeros(N_FEATURES), np.full(N_FEATURES, 1e-4)
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        g = x.T @ (ws * (p - target)) + ridge * theta
        h = (x * (ws * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = theta
    return model


def train(docs: DataFrame) -> Model:
    """Counts the vote patterns of all candidates in Spark and fits the model."""
    src = docs.select("text")
    named = ["kind", "shape", "word", *LABELERS]

    def run(batches):
        for b in C.chunks(batches):
            seen: dict[tuple, int] = {}
            for t in C.texts(b):
                for _, _, (kind, shape, word, v) in judged(t, base_spans(t)):
                    key = (kind, shape, word, *v)
                    seen[key] = seen.get(key, 0) + 1
            cols = [pa.array([k[0] for k in seen], pa.string())]
            cols += [pa.array([k[i] for k in seen], pa.int32()) for i in range(1, len(named))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(list(seen.values()), pa.int64())], names=[*named, "n"])

    counted = C.map_arrow(src, run, "kind string, " + ", ".join(f"{x} int" for x in named[1:]) + ", n long")
    rows = counted.groupBy(*named).agg(F.sum("n").alias("n")).collect()
    rows = sorted(((r["kind"], r["shape"], r["word"], tuple(r[x] for x in LABELERS)), r["n"]) for r in rows)
    return fit([r[0] for r in rows], np.array([r[1] for r in rows]))


def all_spans(text: str, model: Model) -> tuple[list, list]:
    """(base spans, base and added spans sorted by start, then kind). Of
    candidates that overlap the first one accepted stays."""
    base = base_spans(text)
    added, end = [], -1
    for s, e, pattern in judged(text, base):
        if s >= end and model.accepts(pattern):
            added.append((s, e, pattern[0]))
            end = e
    return base, sorted(base + added, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


SPAN_TYPE = "array<struct<start: long, end: long, kind: string>>"


def _span_array(rows: list[list[tuple[int, int, str]]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = [x for r in rows for x in r]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], pa.int64()),
         pa.array([x[2] for x in flat], pa.string())], names=["start", "end", "kind"]))


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, base, spans): base spans and all spans of every whole text."""
    model = train(docs) if model is None else model
    src = docs.select("doc_id", "text")

    def kernel(b):
        found = [all_spans(t, model) for t in C.texts(b)]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), _span_array([f[0] for f in found]), _span_array([f[1] for f in found])],
                                          names=["doc_id", "base", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return C.map_batches(src, kernel, f"doc_id {kind}, base {SPAN_TYPE}, spans {SPAN_TYPE}")


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each run of touching spans replaced by its first kind."""
    out, at, end = [], 0, -1
    for s, e, kind in spans:
        if s >= end:
            out += [text[at:s], f"<{kind.upper()}>"]
        end = at = max(end, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with personal data replaced in ``text``; other columns,
    null texts included, stay as they are (``n_chars`` follows the text where
    it is a number)."""
    src, own = C.private(docs)
    model = train(docs.select(C.ref(text).alias("text")))
    at = own[text]

    def kernel(b):
        out = [None if t is None else redacted(t, all_spans(t, model)[1]) for t in b.column(at).to_pylist()]
        i = b.schema.get_field_index(at)
        return b.set_column(i, b.schema.field(i), pa.array(out, b.schema.field(i).type))

    out = C.map_batches(src, kernel, src.schema.simpleString()[7:-1], at)
    return out.select(*[
        F.char_length(own[text]).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" and docs.schema[c].dataType.simpleString() in ("int", "bigint") else F.col(k).alias(c)
        for c, k in own.items()])
