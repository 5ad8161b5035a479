"""Personal data and secrets replaced by surrogates.

Entities: e-mail addresses, phone numbers, payment-card and other long numbers,
IPv4 addresses, IBANs, access keys, quoted secrets, and names behind a title.  What
holds no letter or digit to replace (`password="******"`) is no entity.

A surrogate has the format of its entity: a letter becomes a letter of the same
case and script, a digit a digit, an octet an octet of as many digits, a card
number keeps its check digit's validity, a given name becomes one of the title's
gender; all else stays.  All texts of one format (kind, and for each place its
alphabet) are numbered, and a keyed permutation without fixed points (a Feistel
network, walked until it falls inside the format) takes one number to another.
So surrogates are distinct by construction, and no entity is its own.

Coreference: an entity's canonical form (lower case, digits only, a phone number
without the country's prefix, ...) decides its surrogate, wherever it is written.
A full name's parts have surrogates of their own, and in its document later
mentions of a part, with a title or bare, get that part's.

Collision checks: over all documents a surrogate must also be no entity that
occurs.  Entities that break this take the permutation's next step until none does.
Formats of which over a quarter occurs have no room for that (four one-digit octets
once 2,500 are in use): there surrogates are distinct, but may be another entity of
the corpus; so it is for what is left after `MAX_ATTEMPTS` rounds.  The entity table
holds distinct entities only.

Not found: names without a title before them, initials, further names than two, and
titles outside the lists below.

Defined results: null text stays null; text without entities stays as it is;
equal doc_ids are separate rows; an empty table gives no rows; further columns
are kept.
"""

from __future__ import annotations

import hashlib
import hmac
import math
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.llm.store import materialize

MAX_ATTEMPTS = 32
#: Titles and their gender, and the names given for them.
MALE_TITLES = "Mr Herr Monsieur Señor Sr Signor Don Sir Lord г-н господин Κύριος"
FEMALE_TITLES = "Mrs Ms Miss Frau Mme Madame Mlle Señora Señorita Sra Signora Doña Lady г-жа госпожа Κυρία"
OTHER_TITLES = "Dr Doctor Prof Professor Dra Profesora Docteur Доктор Профессор"
MALE_NAMES = "Adam Albert Anton Bruno Carl Daniel David Emil Erik Felix Frank Georg Henry Hugo Jakob Jonas Karl Lars Leon Louis Lucas Marco Martin Max Nils Oscar Paul Peter Robert Simon Thomas Victor"
FEMALE_NAMES = "Ada Alma Amelie Anna Bella Carla Celia Clara Diana Edith Elena Ella Emma Eva Flora Greta Hanna Helen Ida Irene Julia Karin Laura Lena Lucy Maria Marta Nina Olivia Paula Rosa Sofia"
_TITLES = "|".join(f"{MALE_TITLES} {FEMALE_TITLES} {OTHER_TITLES}".split())
_UP, _LOW = "A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫЀ-Я", "a-zß-öø-ÿά-ώа-џ"
_MARKS = "\u0300-\u036f\u0591-\u05c7\u064b-\u065f\u0900-\u0dff\u0e00-\u0eff\u1000-\u109f"  # vowel signs in words
KINDS = [
    ("email", rf"(?<![\w.+{_MARKS}-])[\w+{_MARKS}-][\w.+{_MARKS}-]*@[\w{_MARKS}-]+(?:\.[\w{_MARKS}-]+)+"),
    ("key", r"\b(?:AKIA|ASIA)[A-Z0-9]{12,}|\b(?:ghp_|gho_|sk-|xox[bp]-)[A-Za-z0-9-]{16,}"),
    ("secret", r"(?:(?<=token = \")|(?<=token=\")|(?<=key = \")|(?<=key=\")|(?<=secret = \")|(?<=secret=\")|(?<=password = \")|(?<=password=\"))[^\"\s]{6,}(?=\")|\b[0-9a-f]{32,64}\b"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ip", r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d]|\.\d)"),
    ("card", r"(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d])"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])"),
    ("name", rf"(?<=\bTITLE )[{_UP}][{_LOW}]+(?: [{_UP}][{_LOW}]+)?"),
]
#: A superset of the texts that hold an entity, for Spark's own regular expressions, whose \d and \b
#: differ from Python's: of each pattern in KINDS a part that all its matches have, without its edges.
#: What begins with a capital or a digit stands behind one look at that, as most characters are neither.
_D = r"\p{Nd}"
_CAPITALS = "A-Z" + "".join(sorted({t[0] for t in _TITLES.split("|") if t[0] > "Z"}))
MAY_HOLD = (rf"@|(?=[{_CAPITALS}+{_D}])(?:{_D}(?:{_D}{{2}}|\.{_D}|(?:[ -]?{_D}){{12}})|\+{_D}|[A-Z]{{2}}{_D}{{2}} ?[A-Z0-9]{{4}}|AKIA|ASIA"
            rf"|(?<![A-Za-z0-9_])(?:{_TITLES})\.? )|[0-9a-f]{{32}}|gh[po]_|sk-|xox[bp]-|= ?\"")
_NAME = re.compile(rf"\b({_TITLES})\.? (?:(?:{_TITLES})\.? )*([{_UP}][{_LOW}]+(?: [{_UP}][{_LOW}]+)?)")
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS if k != "name"))


def _genders() -> dict[str, str]:
    return {t: g for g, titles in (("m", MALE_TITLES), ("f", FEMALE_TITLES), ("x", OTHER_TITLES)) for t in titles.split()}


def _country(text: str) -> int:
    """Length of a phone number's country prefix, where a separator ends it."""
    m = re.match(r"\+\d{1,3}(?=[ .(-])", text)
    return m.end() if m else 0


def canonical(kind: str, text: str) -> str:
    if kind == "phone":
        text = text[_country(text):]
    if kind in ("card", "phone", "ssn", "iban", "ip") and not text.isascii():
        text = "".join(str(unicodedata.decimal(c, c)) for c in text)
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    return text.lower() if kind == "email" else text


def _free(spans: list[tuple], a: int, b: int) -> bool:
    return all(b <= x[0] or x[1] <= a for x in spans)


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form), in order and without overlaps.  A
    name's kind has the title's gender; a bare surname's is `surname`."""
    out = []
    for m in _ANY.finditer(text):
        canon = canonical(m.lastgroup, m[0])
        if math.prod(map(len, template(m.lastgroup, canon))) > 1:
            out.append((m.start(), m.end(), m.lastgroup, canon))
    gender = _genders()
    names = [(m.start(2), m.end(2), "name" + gender[m[1]], m[2]) for m in _NAME.finditer(text)]
    names = [n for n in names if _free(out, n[0], n[1])]
    if not names:
        return out
    part_kind: dict[str, str] = {}  # what a part of this document's names is
    for _, _, kind, name in names:
        first, *last = name.split(" ")
        if last:
            part_kind.setdefault(first, kind)
            part_kind[last[0]] = "surname"
    for _, _, kind, name in names:
        if " " not in name:
            part_kind.setdefault(name, kind)
    names = [(a, b, kind if " " in name else part_kind[name], name) for a, b, kind, name in names]
    bare = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, part_kind), key=len, reverse=True)) + r")\b")
    taken = out + names
    names += [(m.start(), m.end(), part_kind[m[0]], m[0]) for m in bare.finditer(text) if len(m[0]) > 2 and _free(taken, m.start(), m.end())]
    return sorted(out + names)


def entities(found: list[tuple[int, int, str, str]]) -> set[tuple[str, str]]:
    """(kind, canonical form) of what gets a surrogate: a full name's parts."""
    out = set()
    for _, _, kind, canon in found:
        first, *last = canon.split(" ") if kind.startswith("name") else [canon]
        out |= {(kind, first)} | {("surname", x) for x in last}
    return out


class _Stream:
    """Numbers below a bound from a keyed hash."""

    def __init__(self, key: bytes, label: str):
        self.key, self.label, self.n, self.buf = key, label, 0, b""

    def below(self, n: int) -> int:
        if len(self.buf) < 8:
            self.buf += hmac.new(self.key, f"{self.label}|{self.n}".encode(), hashlib.sha256).digest()
            self.n += 1
        x, self.buf = int.from_bytes(self.buf[:8], "big"), self.buf[8:]
        return x % n


def _luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if d > "4" else 2 * int(d)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


@lru_cache(1 << 14)
def _alphabet(c: str) -> str:
    """What may stand for a character: its digits, or the letters of its case in
    its block of the script; itself alone if it is neither."""
    if c.isdecimal():
        zero = ord(c) - unicodedata.decimal(c)
        return "".join(chr(zero + i) for i in range(10))
    if not c.isalpha():
        return c
    plain = lambda x: next((lo for lo, hi in _PLAIN_LETTERS if lo <= x <= hi), "")
    alike = lambda x: (plain(x), unicodedata.category(x), len(x.upper()) == 1 and x.upper().lower() == x, len(x.lower()) == 1 and x.lower().upper() == x)
    block, kind = ord(c) & ~0x7F, alike(c)
    return "".join(x for x in map(chr, range(block, block + 0x80)) if alike(x) == kind)


#: The common letters of Greek, Cyrillic, Hebrew and Arabic, which stand for each other.
_PLAIN_LETTERS = [("Α", "Ρ"), ("α", "ω"), ("А", "Я"), ("а", "я"), ("א", "ת"), ("ء", "ي")]
_VOWELS = "aeiouy"


def _spoken(c: str) -> str:
    """Vowels for a vowel, consonants for a consonant, where the letter is plain."""
    if not (c.isascii() and c.isalpha()):
        return _alphabet(c)
    some = _VOWELS if c.lower() in _VOWELS else "bcdfghjklmnpqrstvwxz"
    return some.upper() if c.isupper() else some


def template(kind: str, canon: str) -> list[str]:
    """The alphabet of each place of a canonical form; texts with equal
    templates are one format.  An octet is one place of several characters."""
    keep = 0
    if kind == "phone":
        keep = 1 if len(canon) > 10 else 0  # the country's first digit
    elif kind == "iban":
        keep = 2
    elif kind == "key":
        keep = re.match(r"AKIA|ASIA|gh[po]_|sk-|xox[bp]-", canon).end()
    elif kind == "secret" and re.fullmatch(r"[0-9a-f]+", canon):
        return ["0123456789abcdef"] * len(canon)
    elif kind == "card":
        return ["0123456789"] * (len(canon) - 1) + [canon[-1]]  # the check digit follows the others
    elif kind == "email":
        end = canon.rfind(".")
        return [_alphabet(c) for c in canon[:end]] + list(canon[end:])
    elif kind == "surname" or kind.startswith("name"):
        end = len(canon) if canon[:1].isascii() or len(canon) < 4 else len(canon) - 2  # endings tell the gender
        return [_spoken(c) for c in canon[:end]] + list(canon[end:])
    return list(canon[:keep]) + [_alphabet(c) for c in canon[keep:]]


def _octets(canon: str) -> tuple[list[int], list[int], list[int]]:
    """(values, least values, how many) of an address's octets; a leading zero stays."""
    rows = []
    for o in canon.split("."):
        lead = len(o) - len(o.lstrip("0")) if len(o) > 1 else 0
        least, most = {1: (0, 9), 2: (10, 99)}.get(len(o), (100, 255))
        if lead:
            least, most = 0, 10 ** (len(o) - 1) - 1
        rows.append((int(o), least, most - least + 1))
    return tuple(map(list, zip(*rows)))


class Permutation:
    """A keyed permutation of 0 .. n - 1 without fixed points: x goes to
    Q'(Q(x) + shift), Q a Feistel network on the next even number of bits, walked
    until it falls below n, and Q' its inverse."""

    ROUNDS = 6

    def __init__(self, key: bytes, label: str, n: int):
        self.n, self.half = n, max(1, ((n - 1).bit_length() + 1) // 2)
        self.base = hmac.new(key, label.encode(), hashlib.sha256).digest()
        self.width, self.mask = (self.half + 7) // 8, (1 << self.half) - 1

    def _round(self, i: int, x: int) -> int:
        return int.from_bytes(hashlib.shake_256(self.base + bytes([i]) + x.to_bytes(self.width, "big")).digest(self.width), "big") & self.mask

    def _walk(self, x: int, rounds) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            for i in rounds:
                left, right = right, left ^ self._round(i, right)
            x = right << self.half | left  # so that the rounds in reverse order undo it
            if x < self.n:
                return x

    def __call__(self, x: int, attempt: int) -> int:
        shift = 1 + attempt % (self.n - 1)
        return self._walk((self._walk(x, range(self.ROUNDS)) + shift) % self.n, range(self.ROUNDS - 1, -1, -1))


def _mixed(digits: list[int], sizes: list[int]) -> int:
    x = 0
    for d, n in zip(digits, sizes):
        x = x * n + d
    return x


def _unmixed(x: int, sizes: list[int]) -> list[int]:
    out = []
    for n in reversed(sizes):
        x, d = divmod(x, n)
        out.append(d)
    return out[::-1]


def permuted(kind: str, canon: str, attempt: int, key: bytes) -> tuple[str, str, int]:
    """(surrogate, format, texts of that format)."""
    if kind == "ip":
        values, least, sizes = _octets(canon)
        label = "ip|" + ".".join(f"{a}+{n}x{len(o)}" for a, n, o in zip(least, sizes, canon.split(".")))
        digits = [v - a for v, a in zip(values, least)]
    else:
        places = template(kind, canon)
        sizes = [len(p) for p in places]
        label = kind + "|" + "".join(p if len(p) == 1 else f"<{p[0]}{len(p)}>" for p in places)
        if kind == "card":
            label = f"card|{len(canon)}"
        digits = [p.index(c) for p, c in zip(places, canon)]
    n = math.prod(sizes)
    new = _unmixed(Permutation(key, label, n)(_mixed(digits, sizes), attempt), sizes)
    if kind == "ip":
        return ".".join(str(d + a).zfill(len(o)) for d, a, o in zip(new, least, canon.split("."))), label, n
    out = "".join(p[d] for p, d in zip(places, new))
    if kind == "card":  # as far from the valid check digit as before
        out = out[:-1] + str((_check_digit(out[:-1]) + int(canon[-1]) - _check_digit(canon[:-1])) % 10)
    return out, label, n


def _check_digit(digits: str) -> int:
    return next(d for d in range(10) if _luhn(digits + str(d)))


def surrogate(kind: str, canon: str, attempt: int, key: bytes) -> tuple[str, str, int]:
    """(canonical form that stands for `canon`, its format, texts of that format).
    A given name in Latin letters takes one of a list, from the second attempt
    on with letters added: that format has room for any number."""
    if kind.startswith("name") and canon[0] < "\u0250":
        pool = {"namem": MALE_NAMES, "namef": FEMALE_NAMES}.get(kind, MALE_NAMES + " " + FEMALE_NAMES).split()
        pool = [x for x in pool if x != canon]
        s = _Stream(key, f"{kind}|{canon}|{attempt}")
        out = pool[s.below(len(pool))]
        if attempt:
            out += "".join(chr(97 + s.below(26)) for _ in range(1 + attempt // 4))
        return out, kind, 1 << 62
    return permuted(kind, canon, attempt, key)


def write_as(kind: str, text: str, canon: str) -> str:
    """A surrogate in the way that `text` is written."""
    if kind == "phone" and _country(text):
        return text[:_country(text)] + write_as(kind, text[_country(text):], canon)
    if kind in ("card", "phone", "ssn", "iban", "ip"):
        it = iter(canon)
        new = "".join(next(it) if (c.isalnum() if kind == "iban" else c.isdecimal()) or (kind == "ip" and c == ".") else c for c in text)
        # a digit of another script is written in that script
        return new if text.isascii() else "".join(chr(ord(c) - unicodedata.decimal(c) + int(d)) if c.isdecimal() and d.isdecimal() else d for c, d in zip(text, new))
    if kind == "email":
        return "".join(s.upper() if c.isupper() else s for c, s in zip(text, canon))
    return canon


def _mentions(batches):
    for b in batches:
        rows = []
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            rows += [(key, k, c) for k, c in entities(find(text.as_py() or ""))]
            if len(rows) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))], ["_row", "kind", "canon"])
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))], ["_row", "kind", "canon"])


_TABLE = "kind string, canon string, attempt int, surrogate string, format string, room double"


def _assign(key: bytes):
    def run(batches):
        for b in batches:
            kind, canon, attempt = (b.column(i).to_pylist() for i in range(3))
            got = [surrogate(k, c, a, key) for k, c, a in zip(kind, canon, attempt)]
            text, form, room = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(text, pa.string()), pa.array(form, pa.string()), pa.array([math.log2(n) for n in room], pa.float64())],
                                             ["kind", "canon", "attempt", "surrogate", "format", "room"])
    return run


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon), collisions resolved."""
    make = lambda df: materialize(df.mapInArrow(_assign(key), _TABLE), "surrogates")
    known = entities.select("kind", F.col("canon").alias("surrogate")).withColumn("_real", F.lit(True))
    first = make(entities.select("kind", "canon", F.lit(0).alias("attempt")))
    # formats of which over a quarter occurs keep the first step, as do those left at the end
    crowded = materialize(first.groupBy("kind", "format").agg(F.count(F.lit(1)).alias("_n"), F.max("room").alias("_room"))
                               .filter(F.log2("_n") > F.col("_room") - 2).select("kind", "format"), "crowded")
    full = first.join(crowded, ["kind", "format"], "left_semi")
    table = first.join(crowded, ["kind", "format"], "left_anti")
    for attempt in range(MAX_ATTEMPTS + 1):
        # of equal surrogates, the entity that has tried most keeps it: settled ones never change
        best = table.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("attempt", "canon")).alias("_best"))
        taken = best.join(known, ["kind", "surrogate"], "left").filter("_n > 1 OR _real").select(
            "kind", "surrogate", F.when(F.col("_real"), F.lit(None)).otherwise(F.col("_best.canon")).alias("_keeper"))
        bad = table.join(taken, ["kind", "surrogate"]).filter(~F.col("canon").eqNullSafe(F.col("_keeper")))
        bad = materialize(bad.select("kind", "canon", "format", (F.col("attempt") + 1).alias("attempt")), "collisions")
        if not bad.limit(1).count():
            break
        if attempt == MAX_ATTEMPTS:
            left = bad.select("kind", "format").distinct()
            table = table.join(left, ["kind", "format"], "left_anti").unionByName(first.join(left, ["kind", "format"], "left_semi"))
            break
        table = materialize(table.join(bad, ["kind", "canon"], "left_anti").unionByName(make(bad.select("kind", "canon", "attempt"))), "surrogates")
    return table.unionByName(full).select("kind", "canon", "surrogate")


def _write(kind: str, text: str, canon: str, to: dict[tuple[str, str], str]) -> str:
    if kind.startswith("name"):
        first, *last = canon.split(" ")
        return " ".join([to[kind, first], *[to["surname", x] for x in last]])
    return write_as(kind, text, to[kind, canon])


def _replace(schema_names):
    def run(batches):
        at = schema_names.index("text")
        for b in batches:
            texts, maps, counts, out = b.column(at), b.column(len(schema_names)).to_pylist(), [], []
            for text, got in zip(texts, maps):
                text = text.as_py()
                if not got or text is None:
                    out.append(text)
                    counts.append(0)
                    continue
                to = {(m["kind"], m["canon"]): m["surrogate"] for m in got}
                parts, last, found = [], 0, find(text)
                for a, e, kind, canon in found:
                    parts += [text[last:a], _write(kind, text[a:e], canon, to)]
                    last = e
                out.append("".join(parts) + text[last:])
                counts.append(len(found))
            cols = [c if i != at else pa.array(out, pa.string()) for i, c in enumerate(b.columns[: len(schema_names)])]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], [*schema_names, "_n_entities"])
    return run


def pseudonymize(docs: DataFrame, key: bytes, count: str | None = None) -> DataFrame:
    """`docs` with surrogates in `text`; `count`: a column for the number of
    replaced mentions.  Only rows that may hold an entity are shuffled."""
    columns = docs.columns
    safe = docs.toDF(*[c if c == "text" else f"_c{i}" for i, c in enumerate(columns)])
    # rows get a number in a written table, so that both uses of it agree
    may = F.coalesce(F.col("text").rlike(MAY_HOLD), F.lit(False))
    held = materialize(safe.filter(may).withColumn("_row", F.monotonically_increasing_id()), "held")
    mentions = materialize(held.select("_row", "text").mapInArrow(_mentions, "_row long, kind string, canon string"), "mentions")
    named = surrogates(mentions.select("kind", "canon").distinct(), key)
    per_row = (mentions.join(named, ["kind", "canon"]).groupBy("_row")
                       .agg(F.collect_list(F.struct("kind", "canon", "surrogate")).alias("_map")))
    joined = held.join(per_row.hint("merge"), "_row", "left").select(*safe.columns, "_map")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in safe.schema.fields) + ", _n_entities long"
    done = joined.mapInArrow(_replace(safe.columns), schema)
    rest = safe.filter(~may).withColumn("_n_entities", F.lit(0).cast("long"))
    both = done.unionByName(rest)
    out = both.drop("_n_entities").toDF(*columns) if count is None else both.select(*safe.columns, "_n_entities").toDF(*columns, count)
    return out
