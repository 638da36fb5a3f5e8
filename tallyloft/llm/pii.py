"""Surrogates for personal data: keyed, type-consistent, distinct and the same for every mention of an entity.

Detected: e-mail addresses, phone numbers, card numbers (with a right check digit), bank accounts (IBAN), social security numbers, IPv4
addresses, access keys and assigned secrets, and names after a title. Mentions of one entity (case, spacing and punctuation aside) are
one canonical value. A name is its words, whatever title stands before it; the gender of its surrogate is that of most of its titles in
the corpus (neither, if none or as many of both show one). White space within a name may hold one line end, not an empty line.

Coreference within a document: once a title has shown a name, its last word alone, titled or not, and its words in order before that
are mentions of it without a title too, if they begin with capitals, and take the same words of its surrogate. Of several names with that
last word, those that hold the word before it come first, then those of more than one word whose gender the title doesn't contradict; of
these the last before the mention counts, else the first after it. Given names alone are left, as are names that no title shows in the
document.

A keyed hash of type, value and attempt draws the surrogate: digits for digits, letters for letters, with check
digits made right, addresses in range, and names from syllables of the same script and gender.

Distinctness is checked over the whole corpus: of entities that draw the same surrogate one keeps it and the others draw again, and so
does an entity whose surrogate is itself a value in the corpus, until none is left. Once its first draws have failed, an entity's surrogates
grow by a character, syllable or initial an attempt, and signs become letters and digits, so that values of any number find free ones; an
IPv4 address becomes an IPv6 address then. Surrogates are joined back to the mentions by value
(values that hold a notable share of the mentions by broadcast, the others by a shuffle) and written in the mention's own format.

Defined results: a NULL text stays NULL; texts without personal data stay as they are. Of overlapping mentions the first, then the longer one,
counts. Rows that repeat id and text get the same result each. NULL ids are handled like others; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloft.llm.common import HOT_SHARE, attach
from tallyloft.session import stage

MENTIONS = "array<struct<start: int, end: int, kind: string, value: string>>"

_AT = re.compile(r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?<!\w)(?:ghp_|gho_|glpat-|sk_live_|sk-|xox[bp]-)[A-Za-z0-9_-]{16,}")
_SECRET = re.compile(
    r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9+/_.~-]*[A-Za-z0-9+/_~-]{7})")
# Titles that show a name and its gender (f, m; n where they don't).
TITLES = {"Mr": "m", "Mister": "m", "Sir": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Lady": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Herrn": "m",
          "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Sr": "m", "Señora": "f", "Sra": "f", "Srta": "f",
          "Don": "m", "Doña": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}
# White space with one line end at most, without going back into it.
_GAP = r"(?:[^\S\n]++\n?+[^\S\n]*+|\n[^\S\n]*+)"
_WORD = r"[^\W\d_][^\W\d_'’-]+(?:[-'’][^\W\d_]+)*"
_NAME = re.compile(rf"(?<!\w)({'|'.join(sorted(TITLES, key=len, reverse=True))})\b\.?{_GAP}((?:[^\W\d_]\.{_GAP}?|{_WORD}{_GAP}?){{1,3}})")
_CAPITAL = re.compile(rf"(?<!\w)(?:{_WORD}|[^\W\d_]\.)")
_BETWEEN = re.compile(_GAP)
# Syllables and endings of invented names by script.
SYLLABLES = {
    "LATIN": ("ba be bi bo da de di do fa fe fi ga go ha he ja jo ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi".split(),
              {"f": ["a", "ina", "ela"], "m": ["n", "rd", "s"], "n": ["l", "y", "r"]}),
    "CYRILLIC": ("ба бе би бо ва ве ви да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то".split(),
                 {"f": ["а", "ина"], "m": ["н", "р"], "n": ["й", "л"]}),
    "GREEK": ("βα βε δα δε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το".split(),
              {"f": ["α", "η"], "m": ["ς", "ος"], "n": ["ν", "ι"]}),
}


# Draws in the format of the value, before surrogates grow. Kinds of a fixed format have more of them.
DRAWS, FIXED_DRAWS = 4, 32
FIXED = frozenset(["ip", "ssn", "card", "iban", "phone"])


def luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10


def iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _candidates(text: str) -> Iterator[tuple[int, int, str, str]]:
    if "@" in text:
        for m in _AT.finditer(text):
            local = _LOCAL.search(text, max(0, m.start() - 64), m.start())
            if local:
                local_start = local.start() + len(local[0]) - len(local[0].lstrip(".-"))
                if local_start < m.start():
                    yield local_start, m.end(), "email", text[local_start:m.end()].lower()
    if any(map(text.__contains__, string.digits)):
        for m in _IP.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                yield m.start(), m.end(), "ip", ".".join(str(int(x)) for x in m[0].split("."))
        for m in _SSN.finditer(text):
            yield m.start(), m.end(), "ssn", m[0].replace("-", "")
        for m in _CARD.finditer(text):
            if not luhn(digits := re.sub(r"\D", "", m[0])):
                yield m.start(), m.end(), "card", digits
        for m in _PHONE.finditer(text):
            if 7 <= len(digits := re.sub(r"\D", "", m[0])) <= 15:
                yield m.start(), m.end(), "phone", ("+" if m[0][0] == "+" else "") + digits
        for m in _IBAN.finditer(text):
            value = m[0].replace(" ", "")
            if 15 <= len(value) <= 34 and iban_rest(value) == 1:
                yield m.start(), m.end(), "iban", value
    for m in _KEY.finditer(text):
        yield m.start(), m.end(), "key", m[0]
    for m in _SECRET.finditer(text):
        yield m.start(1), m.end(1), "secret", m[1]
    at = 0
    while m := _NAME.search(text, at):
        # Only words that begin with a capital are part of the name, up to the next title.
        start = end = at = m.start(2)
        for w in re.finditer(r"\S+", m[2]):
            if not w[0][0].isupper() or end > start and w[0].rstrip(".") in TITLES and _capital_follows(text, start + w.end()):
                break
            end = start + w.end() - (2 if w[0].endswith(("'s", "’s")) else 0)
            if end < start + w.end():
                break
        if end - start > 1:
            yield start, end, f"name-{TITLES[m[1]]}", _canonical(text[start:end])
            at = end


def _capital_follows(text: str, at: int) -> bool:
    gap = _BETWEEN.match(text, at)
    return bool(gap) and text[gap.end():gap.end() + 1].isupper()


def _canonical(name: str) -> str:
    return " ".join(name.lower().split())


class _Names:
    """The names that a document's titles show, by last word."""

    def __init__(self, found: list[tuple[int, int, str, str]]):
        shown = [(start, kind[-1], value) for start, _, kind, value in found if kind.startswith("name-") and value[-1] != "."]
        genders: dict[str, set[str]] = defaultdict(set)
        for _, gender, value in shown:
            genders[value].add(gender)
        self.places: dict[tuple[str, str], tuple[list[int], list[str]]] = defaultdict(lambda: ([], []))
        for start, _, value in shown:
            *before, surname = value.split(" ")
            own = genders[value] - {"n"}
            # A name without a gender, or with both, fits any title.
            for key in {*before, *(f"-{g}" for g in (own if len(own) == 1 else "mf")), "-n"} if before else [""]:
                starts, values = self.places[surname, key]
                starts.append(start)
                values.append(value)

    def of(self, surname: str, key: str, at: int) -> str | None:
        """The name nearest before ``at``, else the first: with a word before its surname as key, or a title's gender after a hyphen."""
        if (surname, key) not in self.places:
            return None
        starts, values = self.places[surname, key]
        return values[max(0, bisect_left(starts, at) - 1)]


def _repeats(text: str, names: _Names) -> Iterator[tuple[int, int, str, str]]:
    """Mentions without a title of names that titles show."""
    before: list[re.Match] = []  # the last words that begin with a capital and follow each other
    for m in _CAPITAL.finditer(text):
        if not m[0][0].isupper():
            before = []
            continue
        if before and not _BETWEEN.fullmatch(text, before[-1].end(), m.start()):
            before = []
        word = m[0][:-2] if m[0].endswith(("'s", "’s")) else m[0]
        surname = word.lower()
        value = names.of(surname, before[-1][0].lower(), m.start()) if before else None
        value = value or names.of(surname, "-n", m.start()) or names.of(surname, "", m.start())
        if value:
            start, rest = m.start(), value.split(" ")[:-1]
            for w in reversed(before):
                if w[0].lower() not in rest:
                    break
                while rest.pop() != w[0].lower():
                    pass
                start = w.start()
            yield start, m.start() + len(word), "name-n", value
        before = [] if value else [*before[-1:], m]


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of what is personal, in order and apart."""
    out: list[tuple[int, int, str, str]] = []
    for found in sorted(_candidates(text or ""), key=lambda f: (f[0], -f[1])):
        if not out or found[0] >= out[-1][1]:
            out.append(found)
    names = _Names(out)
    if not names.places:
        return out
    for i, (start, end, kind, value) in enumerate(out):
        if kind.startswith("name-") and " " not in value:
            out[i] = start, end, kind, names.of(value, f"-{kind[-1]}", start) or value
    ends = [0, *(found[1] for found in out)]
    starts = [*(found[0] for found in out), len(text)]
    for found in list(_repeats(text, names)):
        i = bisect_left(starts, found[1])  # the first mention that begins where this one ends, or later
        if found[0] >= ends[i]:
            out.append(found)
    return sorted(out)


def script_of(value: str) -> str:
    for c in value:
        if c.isalpha():
            name = unicodedata.name(c, "").split(" ")[0]
            return name if name in SYLLABLES else "LATIN"
    return "LATIN"


def _like(text: str, draw: random.Random) -> str:
    """Digits for digits, letters for letters of the same case; other signs stay."""
    return "".join(
        draw.choice(string.digits) if c.isdigit() else draw.choice(string.ascii_uppercase) if c.isupper() else draw.choice(string.ascii_lowercase)
        if c.isalpha() else c for c in text)


def _hex_like(text: str, draw: random.Random) -> str:
    return "".join(draw.choice("0123456789abcdef") if c in "0123456789abcdef" else c for c in text)


def _any(n: int, draw: random.Random, signs: str = string.ascii_letters + string.digits) -> str:
    return "".join(draw.choice(signs) for _ in range(n))


def _word(like: str, gender: str, script: str, draw: random.Random, last: bool, more: int = 0) -> str:
    syllables, endings = SYLLABLES[script]
    word = "".join(draw.choice(syllables) for _ in range(max(2, round(len(like) / 2.5)) + more))
    return word if last else word + draw.choice(endings[gender])


def surrogate(key: str, kind: str, value: str, attempt: int = 0) -> str:
    """The ``attempt``-th surrogate of a canonical value."""
    seed = hashlib.blake2b(f"{kind}\0{value}\0{attempt}".encode("utf-8", "surrogatepass"), key=key.encode()[:64], digest_size=16).digest()
    draw = random.Random(seed)
    more = max(0, attempt + 1 - (FIXED_DRAWS if kind in FIXED else DRAWS))
    if kind == "email":
        local, _, domain = value.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{_like(local, draw)}{_any(more, draw, string.ascii_lowercase)}@{_like(host, draw)}.{top}"
    if kind == "ip":
        if more:
            return "2001:db8:" + ":".join(f"{draw.getrandbits(16):x}" for _ in range(6))
        return ".".join(str(draw.randint(1, 254)) for _ in range(4))
    if kind == "card":
        head = value[0] + _like(value[1:-1], draw) + _any(more, draw, string.digits)
        return head + str(-luhn(head + "0") % 10)
    if kind == "phone":
        code = 2 if value[0] == "+" else 0  # the first digit of the country's code stays
        return value[:code] + _like(value[code:], draw) + _any(more, draw, string.digits)
    if kind == "iban":
        rest = _like(value[4:], draw) + _any(more, draw, string.digits)
        return f"{value[:2]}{98 - iban_rest(value[:2] + '00' + rest):02d}{rest}"
    if kind == "key":
        head = re.match(r"AKIA|ASIA|ghp_|gho_|glpat-|sk_live_|sk-|xox[bp]-", value)[0]
        tail = value[len(head):]
        if head in ("AKIA", "ASIA"):
            return head + _like(tail, draw) + _any(more, draw, string.ascii_uppercase + string.digits)
        return head + (_any(len(tail) + more, draw) if more or not any(map(str.isalnum, tail)) else _like(tail, draw))
    if kind == "secret":
        if re.fullmatch("[0-9a-f]+", value):
            return _hex_like(value, draw) + _any(more, draw, "0123456789abcdef")
        return _any(len(value) + more, draw) if more or not any(map(str.isalnum, value)) else _like(value, draw)
    if kind.startswith("name-"):
        words = value.split(" ")
        script = script_of(value)
        initial = lambda: draw.choice(SYLLABLES[script][0])[0] + "."
        drawn = [initial() if w.endswith(".") and len(w) == 2 else
                 _word(w, kind[-1], script, draw, i == len(words) - 1, more) for i, w in enumerate(words)]
        if more and all(w.endswith(".") and len(w) == 2 for w in words):
            drawn += [initial() for _ in range(more)]
        return " ".join(drawn)
    return _like(value, draw) + _any(more, draw, string.digits)


def written(mention: str, kind: str, replacement: str, value: str | None = None) -> str:
    """The surrogate in the format of a mention, or the words of it that stand for those of the value that the mention has."""
    if kind in ("phone", "card", "ssn", "iban"):
        signs = iter(replacement.lstrip("+"))
        return "".join(next(signs) if c.isalnum() else c for c in mention) + "".join(signs)
    if kind.startswith("name-"):
        words, drawn = mention.split(), replacement.split(" ")
        held = (value or _canonical(mention)).split(" ")
        if len(words) < len(held):
            at, places = len(held), []
            for w in reversed(words):  # from the surname on
                at = next(i for i in range(at - 1, -1, -1) if held[i] == w.lower())
                places.append(at)
            drawn = [drawn[i] for i in reversed(places)]
        own = (r.upper() if w.isupper() and len(w) > 2 else r.capitalize() for w, r in zip(words + words[-1:] * (len(drawn) - len(words)), drawn))
        return " ".join([re.sub(r"\S+", lambda _: next(own), mention), *own])
    if kind == "email":
        if mention.isupper():
            return replacement.upper()
        return "".join(r.upper() if m.isupper() else r for m, r in zip(mention, replacement)) if len(mention) == len(replacement) else replacement
    return replacement


def _may_hold(text: Column) -> Column:
    """A cheap test that every text with a mention passes: all kinds but keys and names need one of a few signs."""
    found = text.rlike("[0-9@=:_-]")
    # A title that contains another one needs no test of its own.
    for title in sorted(t for t in TITLES if not any(o != t and o in t for o in TITLES)):
        found = found | text.contains(title)
    return F.coalesce(found | text.contains("AKIA") | text.contains("ASIA"), F.lit(False))


def _detector() -> Callable[[Column], Column]:
    @F.pandas_udf(MENTIONS)
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "kind": k, "value": v} for a, b, k, v in mentions(t)] for t in texts])

    return of


def _family() -> Column:
    """Names are told apart whatever their gender, and secrets whatever shows them."""
    return F.when(F.col("kind").startswith("name-"), "name").otherwise(F.col("kind"))


def _entity() -> Column:
    return F.sha2(F.concat_ws(":", _family(), F.col("value")), 256)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``value``, ``surrogate`` for distinct (kind, value): no two of a kind alike, none a value of the corpus."""
    @F.pandas_udf("string")
    def draw(kinds: pd.Series, values: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, v, int(a)) for k, v, a in zip(kinds, values, attempts)], dtype="object")

    entities = stage(entities.select("kind", "value", _family().alias("family")), "pii-entities")
    real = entities.select("family", F.col("value").alias("surrogate")).distinct()
    pending, settled = entities.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = stage(pending.withColumn("surrogate", draw("kind", "value", "attempt")), "pii-drawn")
        first = (drawn.join(real, ["family", "surrogate"], "left_anti").groupBy("family", "surrogate")
                 .agg(F.min(F.struct("kind", "value")).alias("e")).select("family", "surrogate", "e.kind", "e.value"))
        if settled is not None:
            first = first.join(settled.select("family", "surrogate"), ["family", "surrogate"], "left_anti")
        first = stage(first, "pii-settled")
        settled = first if settled is None else settled.unionByName(first)
        pending = drawn.join(first.select("kind", "value"), ["kind", "value"], "left_anti").drop("surrogate").withColumn("attempt", F.col("attempt") + 1)
        if not pending.take(1):
            return settled.select("kind", "value", "surrogate")


def replaced(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_replaced") -> DataFrame:
    """``docs`` with surrogates in ``text_col`` and the number of mentions replaced in ``count_col``, which takes the place of a column of that name."""
    docs = docs.drop(count_col)
    # Ids and texts have equal codes only if they are equal.
    named = F.col(id_col).cast("string")
    code = F.sha2(F.concat(F.coalesce(F.length(named), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(named, F.lit("")), F.col(text_col)), 256)
    may = _may_hold(F.col(text_col))
    found = docs.filter(may).select(code.alias("__code"), F.explode(_detector()(F.col(text_col))).alias("m")).select("__code", "m.*")
    found = stage(found.dropDuplicates(["__code", "start"]).withColumn("entity", _entity()), "pii-mentions")
    shown = [F.count_if(F.col("kind") == f"name-{g}") for g in "fm"]
    gender = F.when(shown[0] > shown[1], "name-f").when(shown[1] > shown[0], "name-m").otherwise("name-n")
    sizes = stage(found.groupBy(_family().alias("family"), "value", "entity").agg(F.count("*").alias("n"), gender.alias("gender"))
                  .withColumn("kind", F.when(F.col("family") == "name", F.col("gender")).otherwise(F.col("family"))), "pii-sizes")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    facts = stage(surrogates(sizes.select("kind", "value"), key).select(_entity().alias("entity"), "surrogate"), "pii-surrogates")
    whole = attach(found, facts, "entity", sizes.filter(F.col("n") * HOT_SHARE >= total))
    by_text = whole.groupBy("__code").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "surrogate", "value"))).alias("__found"))

    @F.pandas_udf("string")
    def write(texts: pd.Series, founds: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, founds):
            parts, at = [], 0
            for m in own if own is not None else ():
                parts += [text[at:m["start"]], written(text[m["start"]:m["end"]], m["kind"], m["surrogate"], m["value"])]
                at = m["end"]
            out.append("".join(parts) + text[at:] if at else text)
        return pd.Series(out, dtype="object")

    marked = docs.filter(may).withColumn("__code", code).join(by_text, "__code", "left")
    done = marked.withColumns({count_col: F.coalesce(F.array_size("__found"), F.lit(0)).cast("bigint"), text_col: write(F.col(text_col), F.col("__found"))})
    return done.select(*docs.columns, count_col).unionByName(docs.filter(~may).withColumn(count_col, F.lit(0).cast("bigint")))
