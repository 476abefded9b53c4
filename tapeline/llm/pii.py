"""Personal data: detected entities get keyed surrogates of the same type, gender, script and format, distinct and coreferent."""

from __future__ import annotations

import hmac
import re
import unicodedata
from collections import ChainMap
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm._shared import chunks, drop_staged, stage

# First names by gender and script, titles, and what surnames are made of.
FEMALE = {"latin": "Anna Maria Emma Sophie Laura Julia Clara Elena Alice Marta Nina Sara Eva Lucia Helen Mary Jane Susan Linda Karen".split(), "cyrillic": "Анна Мария Елена Ольга Ирина Наталья Светлана Татьяна".split()}
MALE = {"latin": "John Peter Paul Thomas Martin Daniel David James Robert Michael Hans Pierre Carlos Juan Luis Marc Simon Victor Frank Oscar".split(), "cyrillic": "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил".split()}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Señor": "m", "Señora": "f", "Signor": "m", "Signora": "f", "Senhor": "m", "Senhora": "f"}
# Titles of rank; "u" has no gender.
TITLES |= {"Sir": "m", "Lord": "m", "Lady": "f", "Madam": "f", "Mme": "f", "Mlle": "f", "Sr": "m", "Sra": "f", "Dr": "u", "Doctor": "u", "Prof": "u", "Professor": "u"}
SYLLABLES = {"latin": "ba be ca da do fe ga ha ja ka la le ma mo na ne pa ra ro sa se ta te va vi wa".split(), "cyrillic": "ба ве га да жо за ка ла ма не по ра са та фе ха ча ша".split()}
ENDINGS = {"latin": ("son", "son"), "cyrillic": ("ов", "ова")}
# Country calling codes of one and of two digits; all others have three.
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()

GENDER = {n.casefold(): g for g, lists in (("f", FEMALE), ("m", MALE)) for own in lists.values() for n in own}
CAPITAL = r"[^\W\d_]+(?:[-'’][^\W\d_]+)?"
#: A mail address' parts have bounded lengths and start where no such character stands before, so that each is tried once.
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]{0,63}\w@(?:[\w-]{1,63}\.){1,8}\w{2,63})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<!\d)(?<!\d\.)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<card>(?<!\w)(?<!\d\.)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w))"
    r"|(?P<phone>(?<!\d)(?:\+1[ .-]?)?(?:\(\d{3}\)[ .-]?|(?<!\w)\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<!\d)\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\d)"
    r"|(?<![\w.+-])0[1-9](?:\d{0,3}(?:[ /-]\d{6,8}| \d{3,4}[ -]\d{3,5})|(?: \d\d){4})(?!\w|[ .-]\d))"
    r"|(?P<ssn>(?<!\w)\d{3}-\d{2}-\d{4}(?!\w))"
)
#: A text without any of these has none of the entities above.
HINT = re.compile(r"[\d@]")
#: A title, up to three more after it ("Frau Prof. Dr."), and one or two words.
TITLED = re.compile(rf"\b(?P<title>{'|'.join(TITLES)})\b\.?(?: (?:{'|'.join(TITLES)})\b\.?){{0,3}} (?P<name>{CAPITAL}(?: {CAPITAL})?)")
WORD = re.compile(CAPITAL)
#: First names that the corpus teaches and all tasks hold, at most, and titled mentions in different documents that make one.
MAX_LEARNT, LEAST_DOCS = 20_000, 2
#: Times that first names teach surnames and those further first names.
ROUNDS = 3


def script(text: str) -> str:
    """The script of a name by its first letter, as Unicode names it: latin, cyrillic, greek, arabic, cjk and so on."""
    return next((unicodedata.name(c, "latin").split()[0].lower() for c in text if c.isalpha()), "latin")


def _digits(mention: str) -> str:
    """The digits of a number, whatever their script, as ASCII."""
    return "".join(str(unicodedata.digit(c)) for c in mention if c.isdecimal())


def _phone(mention: str) -> str:
    """``<country code>|<number>``; numbers without a plus, or with code 1, share the code 1; those that begin with a trunk
    zero have the code 0, as their country isn't known."""
    digits = _digits(mention)
    if mention.startswith("0"):
        return f"0|{digits[1:]}"
    if not mention.startswith("+"):
        return f"1|{digits[-10:]}"
    own = next((c for c in CALLING if digits.startswith(c)), digits[:3])
    return f"{own}|{digits[len(own):]}"


def canonical(kind: str, mention: str) -> str:
    """What two mentions of one entity share."""
    if kind == "email":
        return mention.lower()
    if kind in ("card", "ssn"):
        return _digits(mention)
    if kind == "phone":
        return _phone(mention)
    return re.sub(r"\s", "", mention).upper() if kind == "iban" else mention


def _is_name(word: str) -> bool:
    """Whether a word begins with a capital, or its script has none."""
    return word[0].isupper() or unicodedata.category(word[0]) == "Lo"


def _people(text: str, genders: Mapping[str, str]) -> list[tuple[int, int, str, str]]:
    """Spans of people: a known first name before a capitalised word, a title before one or two, and what refers to them."""
    people: dict[str, str] = {}
    spans: list[tuple[int, int, str, str]] = []
    last = None
    for m in WORD.finditer(text) if genders else ():
        if last and m.start() == last.end() + 1 and text[last.end()] == " " and m[0][0].isupper() and last[0][0].isupper():
            first = last[0].casefold()
            value = f"{genders[first]}|{first}|{m[0].casefold()}"
            people.setdefault(m[0].casefold(), value)
            spans.append((last.start(), m.end(), "person", value))
            last = None
        else:
            last = m if m[0].casefold() in genders else None
    titled = [(m, parts) for m in TITLED.finditer(text) if (parts := [p for p in m["name"].split() if _is_name(p)]) and parts[0] not in TITLES]
    for count in (2, 1):  # full names first, so that surnames find them
        for m, parts in titled:
            if len(parts) != count:
                continue
            name = parts[-1].casefold()
            first = parts[0].casefold() if count == 2 else ""
            value = people.get(name) if not first or first in genders else None
            value = value or f"{TITLES[m['title']]}|{first}|{name}"
            people.setdefault(name, value)
            start = m.start("name")
            spans.append((start, start + len(" ".join(parts)), "person", value))
    if people:
        spans += [(m.start(), m.end(), "person", people[m[0].casefold()]) for m in WORD.finditer(text) if m[0].casefold() in people and m[0] in (m[0].title(), m[0].upper())]
    return spans


def find(text: str, genders: Mapping[str, str] = GENDER) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` of all entities, in order, without overlaps. A person's value is gender, first and last name.

    A surname alone refers to the person of that name that the text names in full first. ``genders`` are the known first
    names. The work is in proportion to the text, however long its words and however many its people.
    """
    out = [(m.start(), m.end(), m.lastgroup, canonical(m.lastgroup, m[0])) for m in PATTERN.finditer(text)] if HINT.search(text) else []
    done: list[tuple[int, int, str, str]] = []
    for item in sorted([*out, *_people(text, genders)], key=lambda x: (x[0], -x[1])):
        if not done or item[0] >= done[-1][1]:
            done.append(item)
    return done


class _Draw:
    """A stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *of: object):
        self.seed, self.state = hmac.new(key, "\0".join(map(str, of)).encode(), "sha256").digest(), 0
        self.bits, self.left = 0, 0

    def below(self, n: int) -> int:
        if self.left < 40:
            self.bits = int.from_bytes(hmac.new(self.seed, b"%d" % self.state, "sha256").digest())
            self.state, self.left = self.state + 1, 256
        out = self.bits % n
        self.bits, self.left = self.bits // n, self.left - n.bit_length()
        return out


@lru_cache(4096)
def _letters(c: str) -> str:
    """Letters that may stand for ``c``: of its script and case, from its neighbourhood of 64 code points."""
    if c.isascii():
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else "abcdefghijklmnopqrstuvwxyz"
    own = lambda x: (unicodedata.category(x), (name := unicodedata.name(x, "")).split(" ")[0], " LETTER " in name)
    base = ord(c) & ~63
    # one character in either case, so that a mention in capitals finds its way back; letters of one alphabet have one distance between cases
    apart = lambda x: ord(x.upper()) - ord(x.lower()) if len(x.lower()) == len(x.upper()) == 1 and x in (x.upper().lower(), x.lower().upper()) else None
    return "".join(x for x in map(chr, range(base, base + 64)) if own(x) == own(c) and apart(x) is not None and apart(x) == apart(c)) or c


def _like(c: str, draw: _Draw) -> str:
    """A character of the same class, case and script."""
    if c.isdigit():
        return str(draw.below(10))
    if c.isalpha():
        letters = _letters(c)
        return letters[draw.below(len(letters))]
    return c


def _luhn(digits: str) -> int:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10


def _mod97(iban: str) -> int:
    """One for an account number whose check digits are right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of an entity's canonical value; another ``attempt`` gives another."""
    draw = _Draw(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        host, dot, fixed = domain.rpartition(".")
        if host == "example" or host.endswith(".example"):  # names reserved for examples stay reserved
            host, fixed = host[: -len("example")], f"example{dot}{fixed}"
            dot = ""
        of_host = _Draw(key, "host", domain)  # one host keeps one surrogate
        tail = str(draw.below(10 ** min(9, attempt))) if attempt > 3 else ""  # short names run out of others of their length
        return f"{''.join(_like(c, draw) for c in local)}{tail}@{''.join(_like(c, of_host) for c in host)}{dot}{fixed}"
    if kind == "ip":
        own = value.split(".")
        keep = 1 if own[0] == "10" else 2 if own[:2] == ["192", "168"] else 0
        return ".".join(own[i] if i < keep else str(1 + draw.below(223) if i == 0 else draw.below(256)) for i in range(4))
    if kind == "card":
        body = value[0] + "".join(str(draw.below(10)) for _ in value[1:-1])
        wanted = 0 if _luhn(value) == 0 else 1 + draw.below(9)
        return next(body + str(d) for d in range(10) if _luhn(body + str(d)) == wanted)
    if kind == "person":
        gender, first, last = value.split("|", 2)
        style = script(last)
        if style in SYLLABLES:
            names = {"f": FEMALE[style], "m": MALE[style]}.get(gender, FEMALE[style] + MALE[style])
            syllables = SYLLABLES[style]
            made = lambda n: "".join(syllables[draw.below(len(syllables))] for _ in range(n))
            parts = re.split(r"([-'’])", last)  # double names stay double, O'Neill keeps its mark
            new = "".join(p if i % 2 else _like(p, draw) if len(p) == 1 else made(2 + min(attempt, 6)) + ENDINGS[style][gender == "f"] for i, p in enumerate(parts))
            return f"{gender}|{names[draw.below(len(names))].casefold() if first else ''}|{new}"
        longer = last[-1:] * min(attempt, 6)  # a short name runs out of others of its length
        return f"{gender}|{''.join(_like(c, draw) for c in first)}|{''.join(_like(c, draw) for c in last + longer)}"
    if kind == "phone":
        country, _, number = value.partition("|")
        line = country == "1" and len(number) == 10 and number[3:6] == "555"  # numbers of the fictitious exchange stay in it
        first = number[:1] if number[:1] in ("", "0") else str(2 + draw.below(8))
        own = first + "".join(_like(c, draw) for c in number[1:])
        return f"{country}|{own[:3] + '555' + own[6:] if line else own}"
    if kind == "iban":
        body = "".join(_like(c, draw) for c in value[4:])
        check = 98 - _mod97(f"{value[:2]}00{body}")
        if _mod97(value) != 1:  # wrong check digits stay wrong
            check = (check + draw.below(96)) % 97 + 1
        return f"{value[:2]}{check:02d}{body}"
    return "".join(_like(c, draw) for c in value)


def _cased(new: str, old: str) -> str:
    if old.isupper() and len(old) > 1:
        return new.upper()
    out = new.title() if old[:1].isupper() else new
    return out[:-1] + "ς" if len(out) > 1 and out[-1] == "σ" else out


def render(kind: str, mention: str, value: str, new: str) -> str:
    """A canonical surrogate in the format of the mention."""
    if kind == "person":
        first, last = value.split("|")[1:]
        new_first, new_last = new.split("|")[1:]
        words = mention.split()
        if len(words) > 1:
            return f"{_cased(new_first, words[0])} {_cased(new_last, words[1])}" if new_first else " ".join([_cased(new_last, words[-1])])
        return _cased(new_last if words[0].casefold() == last or not new_first else new_first, words[0])
    if kind == "email":
        return new.upper() if mention.isupper() else new
    if kind == "ip":
        return new
    if kind == "phone":
        country, _, new = new.partition("|")
        if len(country) + len(new) == sum(map(str.isdecimal, mention)) and mention.startswith("+"):
            new = country + new
    chars = [i for i, c in enumerate(mention) if (c.isalnum() if kind == "iban" else c.isdecimal())]
    out = list(mention)
    for i, c in zip(chars[-len(new) :], new, strict=False):
        out[i] = chr(ord(mention[i]) - unicodedata.digit(mention[i]) + int(c)) if mention[i].isdecimal() and c.isdigit() else c  # digits of the mention's script
    return "".join(out)


def _entities(batches: Iterator[pa.RecordBatch], genders: dict[str, str]) -> Iterator[pa.RecordBatch]:
    for ids, rids, texts, rest in chunks(batches, "doc_id", "rid", "text", "own"):
        rows = [(d, i, k, v) for d, i, t, own in zip(ids, rids, texts, rest, strict=True) if t for k, v in sorted({x[2:] for x in find(t.decode(), _known(genders, own))})]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["doc_id", "rid", "kind", "value"])


def _drawn(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    for kinds, values, attempts in chunks(batches, "kind", "value", "attempt"):
        kinds, values = [k.decode() for k in kinds], [v.decode() for v in values]
        new = [surrogate(key, k, v, a) for k, v, a in zip(kinds, values, attempts, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(attempts, pa.int32()), pa.array(new, pa.string())], names=["kind", "value", "attempt", "surrogate"])


def assign(values: DataFrame, key: bytes, max_rounds: int = 50) -> DataFrame:
    """``(kind, value, attempt, surrogate)`` for distinct ``(kind, value)``, with distinct surrogates that are nobody's value.

    All values draw; of those that drew the same the first keeps it, and the others, like those who drew a value that
    occurs, draw again, until none is left.
    """
    ddl = "kind string, value string, attempt int, surrogate string"
    now = stage(values.withColumn("attempt", F.lit(0)).mapInArrow(lambda it: _drawn(it, key), ddl), "surrogates")
    taken = values.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("taken"))
    order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "value")  # the few that drew the same
    for _ in range(max_rounds):
        judged = now.join(taken, ["kind", "surrogate"], "left").withColumn("bad", F.coalesce("taken", F.lit(False)) | (F.row_number().over(order) > 1)).select("kind", "value", "attempt", "surrogate", "bad")
        judged = stage(judged, "judged")
        if judged.where("bad").isEmpty():
            drop_staged(judged)
            return now
        again = judged.where("bad").select("kind", "value", (F.col("attempt") + 1).alias("attempt")).mapInArrow(lambda it: _drawn(it, key), ddl)
        before, now = now, stage(judged.where("not bad").drop("bad").select("kind", "value", "attempt", "surrogate").unionByName(again), "surrogates")
        drop_staged(before)
        drop_staged(judged)
    raise RuntimeError(f"surrogates still collide after {max_rounds} rounds")


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def replace(text: str, new: dict[tuple[str, str], str], genders: Mapping[str, str] = GENDER) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and where they stand in it."""
    parts, spans, last, at = [], [], 0, 0
    for start, end, kind, value in find(text, genders):
        own = render(kind, text[start:end], value, new[kind, value])
        parts += [text[last:start], own]
        at += start - last
        spans.append((kind, at, at + len(own)))
        at, last = at + len(own), end
    return "".join([*parts, text[last:]]), spans


def _replaced(batches: Iterator[pa.RecordBatch], genders: dict[str, str]) -> Iterator[pa.RecordBatch]:
    for ids, texts, found, rest in chunks(batches, "doc_id", "text", "found", "own"):
        out_texts, out_spans = [], []
        for raw, own, names in zip(texts, found, rest, strict=True):
            if raw is None or not own:
                out_texts.append(None if raw is None else raw.decode())
                out_spans.append([])
                continue
            text, spans = replace(raw.decode(), {(x["kind"], x["value"]): x["surrogate"] for x in own}, _known(genders, names))
            out_texts.append(text)
            out_spans.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out_texts, pa.string()), pa.array(out_spans, SPANS)], names=["doc_id", "text", "entities"])


def _pairs(docs: DataFrame) -> DataFrame:
    """``(first, last, n)``: two capitalised words that follow a lower-case word, so that no sentence begins with them, in n rows."""
    pattern = r"(?<=[\p{Ll},;] )(\p{Lu}[\p{L}'’-]+) (\p{Lu}[\p{L}'’-]+)"
    hits = docs.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))).alias("hit"))
    words = F.split(F.lower("hit"), " ")
    return hits.groupBy(words[0].alias("first"), words[1].alias("last")).agg(F.count("*").alias("n"))


def _learnt(pairs: DataFrame, titled: DataFrame, known: DataFrame, least_docs: int) -> DataFrame:
    """``(first, good)``: first names that ``pairs`` teach beyond ``known(first)``, and ``titled(last, n)``, surnames after titles.

    A surname follows known first names or titles in ``least_docs`` rows and in a fifth of its pairs. A first name precedes two
    or more different surnames in ``least_docs`` rows and in most of its pairs, and is no commoner as a surname. So
    "Main Street" and "North Street" teach nothing after one "Maria Street", as streets seldom follow first names.
    """
    marked = pairs.join(known.select("first").distinct().withColumn("known", F.lit(True)), "first", "left")
    after = marked.select("last", "n", F.when(F.col("known"), F.col("n")).otherwise(0).alias("good")).unionByName(titled.select("last", "n", F.col("n").alias("good")))
    surnames = after.groupBy("last").agg(F.sum("n").alias("all"), F.sum("good").alias("as_last")).where((F.col("as_last") >= least_docs) & (5 * F.col("as_last") >= F.col("all"))).select("last", "as_last")
    before = marked.where("known IS NULL").join(surnames, "last", "left").groupBy("first").agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("as_last").isNotNull(), F.col("n")).otherwise(0)).alias("good"), F.count("as_last").alias("surnames"))
    found = before.where((F.col("good") >= least_docs) & (F.col("surnames") >= 2) & (2 * F.col("good") > F.col("all")))
    rare = found.join(surnames.select(F.col("last").alias("first"), "as_last"), "first", "left").where(F.col("good") > F.coalesce("as_last", F.lit(0)))
    return rare.select("first", "good")


def taught(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(first, gender, round, good)``: all first names beyond the fixed lists that the whole corpus teaches, written.

    A word between a title and another capitalised word, in ``least_docs`` documents or more, is a first name of the title's
    gender; if titles of both genders precede it, of the commoner one. Words that are somebody's surname more often aren't first
    names. Then first names teach surnames, and surnames further first names (:func:`_learnt`), without a gender, in :data:`ROUNDS`
    rounds or until nothing is new. Scripts without capitals teach nothing.
    """
    any_title = "|".join(TITLES)
    titles = F.create_map(*[F.lit(x) for pair in TITLES.items() for x in pair])
    pattern = rf"\b({any_title})\b\.?(?: (?:{any_title})\b\.?){{0,3}} (\p{{Lu}}[\p{{L}}'’-]+)(?: (\p{{Lu}}[\p{{L}}'’-]+))?"
    has = F.col("text").rlike(rf"\b({any_title})\b")
    hits = docs.where(has).select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))).alias("hit"))
    part = lambda i: F.regexp_extract("hit", pattern, i)
    named = hits.select(titles[part(1)].alias("gender"), F.lower(part(2)).alias("one"), F.lower(part(3)).alias("two"))
    named = stage(named.groupBy("gender", F.when(F.col("two") != "", F.col("one")).alias("first"), F.when(F.col("two") != "", F.col("two")).otherwise(F.col("one")).alias("last")).agg(F.count("*").alias("n")), "titled")
    both = named.select(F.explode(F.array(F.struct(F.col("first").alias("name"), "gender", F.col("n").alias("as_first"), "n"), F.struct(F.col("last").alias("name"), "gender", F.lit(0).cast("long").alias("as_first"), "n"))).alias("x")).select("x.*")
    of = lambda g: F.sum(F.when(F.col("gender") == g, F.col("as_first")).otherwise(0)).alias(g)
    known = both.where("name IS NOT NULL").groupBy("name").agg(F.sum("as_first").alias("firsts"), F.sum("n").alias("all"), of("f"), of("m"))
    fixed = docs.sparkSession.createDataFrame([(n,) for n in sorted(GENDER)], "first string")
    gender = F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > 0, "m").otherwise("u")
    found = known.where((F.col("firsts") >= least_docs) & (2 * F.col("firsts") > F.col("all")) & ~F.col("name").isin(*GENDER))
    out = stage(found.select(F.col("name").alias("first"), gender.alias("gender"), F.lit(0).alias("round"), F.col("firsts").alias("good")), "taught")
    pairs, titled = stage(_pairs(docs), "pairs"), named.groupBy("last").agg(F.sum("n").alias("n"))
    for n in range(ROUNDS):
        more = stage(_learnt(pairs, titled, out.select("first").unionByName(fixed), least_docs).select("first", F.lit("u").alias("gender"), F.lit(n + 1).alias("round"), "good"), "more")
        if more.isEmpty():
            drop_staged(more)
            break
        before, out = out, stage(out.unionByName(more), "taught")
        drop_staged(before)
        drop_staged(more)
    drop_staged(named)
    drop_staged(pairs)
    return out


def _commonest(names: DataFrame, at_most: int) -> tuple[dict[str, str], DataFrame | None]:
    """The ``at_most`` first names of :func:`taught`, titles' first, then by round and number, with the fixed lists; and the rest."""
    taken = names.orderBy("round", F.desc("good"), "first").limit(at_most).collect()
    known = {r["first"].casefold(): r["gender"] for r in taken} | GENDER
    if len(taken) < at_most or not taken:
        return known, None
    n, good, first = (F.lit(taken[-1][c]) for c in ("round", "good", "first"))
    later = (F.col("round") == n) & ((F.col("good") < good) | ((F.col("good") == good) & (F.col("first") > first)))
    rest = names.where((F.col("round") > n) | later).select("first", "gender")
    return known, None if rest.isEmpty() else rest


def first_names(docs: DataFrame, least_docs: int = LEAST_DOCS, at_most: int = MAX_LEARNT) -> dict[str, str]:
    """Known first names, case-folded, with their gender: the fixed lists, and the ``at_most`` commonest that the corpus teaches
    (:func:`taught`)."""
    return _commonest(taught(docs, least_docs), at_most)[0]


def _folded(c: str) -> Column:
    return F.replace(F.translate(F.lower(c), "ς", "σ"), F.lit("ß"), F.lit("ss"))


def _with_rest(docs: DataFrame, rest: DataFrame | None) -> DataFrame:
    """``docs(doc_id, rid, text)`` with ``own``, those names of ``rest(first, gender)`` that a text has; null where it has none."""
    if rest is None:
        return docs.withColumn("own", F.lit(None).cast("array<struct<first:string,gender:string>>"))
    words = docs.select("doc_id", "rid", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{L}*(?:[-'’]\p{L}+)?"), F.lit(0)))).alias("word"))
    hits = words.select("doc_id", "rid", _folded("word").alias("key")).join(rest.withColumn("key", _folded("first")), "key")
    own = hits.groupBy(F.col("doc_id").alias("__id"), F.col("rid").alias("__rid")).agg(F.collect_set(F.struct("first", "gender")).alias("own"))  # a text's own
    return docs.join(own, docs["doc_id"].eqNullSafe(own["__id"]) & (docs["rid"] == own["__rid"]), "left").select("doc_id", "rid", "text", "own")


def _known(genders: dict[str, str], own: list[dict] | None) -> Mapping[str, str]:
    return ChainMap({x["first"].casefold(): x["gender"] for x in own}, genders) if own else genders


def pseudonymise(docs: DataFrame, key: bytes, at_most: int = MAX_LEARNT) -> DataFrame:
    """``(doc_id, text, entities)`` for each row of ``docs(doc_id, text)``: whole texts with surrogates and their places.

    An entity has one surrogate in the whole corpus, different entities have different ones, and none is a value that
    occurs. The key decides them: keep it secret. People without a known gender get a name of either. Null texts stay null; texts without entities stay as they are; rows of
    equal or null doc_id are told apart by their texts, so a row carries its own entities only; other columns are ignored; an
    empty table gives an empty result. The ``at_most`` commonest first names that are learnt go to all tasks; the rest come to the
    texts that have them by a join.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("rid"), "text")
    genders, rest = _commonest(taught(docs), at_most)
    docs = _with_rest(docs, rest)
    entities = stage(docs.mapInArrow(lambda it: _entities(it, genders), "doc_id bigint, rid bigint, kind string, value string"), "entities")
    chosen = assign(entities.select("kind", "value").distinct(), key)
    own = entities.distinct().join(chosen, ["kind", "value"]).groupBy(F.col("doc_id").alias("__id"), F.col("rid").alias("__rid")).agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("found"))  # a text's own
    joined = docs.join(own, docs["doc_id"].eqNullSafe(own["__id"]) & (docs["rid"] == own["__rid"]), "left").select("doc_id", "text", "found", "own")
    return joined.mapInArrow(lambda it: _replaced(it, genders), "doc_id bigint, text string, entities array<struct<kind:string,start:bigint,end:bigint>>")
