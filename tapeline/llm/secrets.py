"""Secret scans: candidates by pattern, false positives removed by a random forest. Built-in expressions and the DataFrame-based ML library only."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from math import log

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm._shared import shares, stage

#: A run that may be a secret: it starts where no such character stands before.
CANDIDATE = r"(?<![A-Za-z0-9_+/.\-])[A-Za-z0-9_+/.\-]{16,}+={0,2}"
#: Characters before and after a run in which its neighbours are sought.
NEAR = 64
#: Characters that a run has at least, and how many runs so many characters can touch.
MIN_RUN = 16
BACK = NEAR // MIN_RUN
#: Words before which an assigned value is mostly a secret.
KEYWORDS = r"(?i)(token|secret|passw(or)?d|passwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer)"
#: How well-known secrets begin.
PREFIXES = r"^(AKIA|ASIA|ghp_|gho_|ghs_|glpat-|xox[abps]-|sk_live_|sk-|eyJ)"
ASSIGNED = r"[=:]\s*[\"'`]?$"
#: Labelled findings that the forest is fitted on, about: a hash draws them by label where there are more, weighted back to all.
TRAIN_ROWS = 20_000
#: Documents that lend a context to a planted finding, about, and characters of it on each side.
PLANTED = 8_000
CONTEXT = 200
#: Words of the dictionary: those of four letters and more that most documents have.
DICTIONARY = 2_000
#: Words that names of things and placeholders are made of.
NAMING = (
    "user name file path list test data value type code host port mail home temp index main root base time date event state error class object string number table column field model config default "
    "example sample dummy placeholder changeme please insert replace your here goes token secret password passwd private public access client server service account admin login session request response"
).split()
#: Categories of a path.
PATHS = 16
# Words of paths in which findings are mostly made up, and of paths in which they mostly aren't.
UNREAL = r"(?i)(^|[/_.\-])(tests?|fixtures?|examples?|samples?|docs?|vendor|node_modules|mocks?|demo)([/_.\-]|$)"
REAL = r"(?i)(^|[/_.\-])(config|settings|deploy|prod|production|env|infra|secrets?|credentials?)([/_.\-]|$)"
# Paths that planted findings stand in, with the share of secrets in each kind. The first kind is the document's own source.
PLACES = [([""], 0.5), (["/tests/fixtures/data.py", "/vendor/lib/package.js", "/docs/guide.md", "/examples/demo.sh", "/src/sample_test.go"], 0.2), (["/config/app.yaml", "/.env", "/deploy/values.yaml", "/infra/main.tf", "/settings/production.py"], 0.8)]

FEATURES = ["length", "turns", "bigrams", "digits", "distinct", "vowels", "coverage", "keyword", "assigned", "quoted", "prefix", "unreal", "real", *(f"path{i}" for i in range(PATHS))]


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """Findings ``(doc_id, path, start, candidate, left, right)`` in whole texts of ``docs(doc_id, text, source)``, with the columns ``keep``.

    ``start`` counts characters of the original text; ``left`` and ``right`` are the NEAR characters next to the run,
    other runs included. A text is split at its runs, so the work is in proportion to its length. Null texts yield nothing.
    """
    split = docs.select("doc_id", *keep, F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("runs"), F.split("text", CANDIDATE, -1).alias("gaps")).where(F.size("runs") > 0)
    sizes = F.zip_with("runs", F.slice("gaps", F.lit(1), F.size("runs")), lambda r, g: F.struct(F.char_length(r).alias("run"), F.char_length(g).alias("gap")))
    # where each run starts: the sum of all gaps and runs before
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(sizes, zero, lambda a, s: F.struct((a["at"] + s["gap"] + s["run"]).alias("at"), F.array_append(a["starts"], a["at"] + s["gap"]).alias("starts")), lambda a: a["starts"])
    # NEAR characters reach over BACK runs at most, as each has MIN_RUN or more
    pieces = F.zip_with(F.transform("gaps", lambda g: F.right(g, F.lit(NEAR))), F.transform("runs", lambda r: F.right(r, F.lit(NEAR))), lambda g, r: F.concat(g, F.coalesce(r, F.lit(""))))
    heads = F.zip_with(F.transform("runs", lambda r: F.left(r, F.lit(NEAR))), F.transform(F.slice("gaps", F.lit(2), F.size("runs")), lambda g: F.left(g, F.lit(NEAR))), lambda r, g: F.concat(r, g))
    at = lambda xs, i: F.coalesce(F.when(i >= 0, F.get(xs, i)), F.lit(""))
    lefts = F.transform("gaps", lambda g, i: F.right(F.concat(*[at(F.col("pieces"), i - k) for k in range(BACK, 0, -1)], F.right(g, F.lit(NEAR))), F.lit(NEAR)))
    rights = F.transform("gaps", lambda g, i: F.left(F.concat(F.left(g, F.lit(NEAR)), *[at(F.col("heads"), i + k) for k in range(BACK)]), F.lit(NEAR)))
    split = split.withColumns({"pieces": pieces, "heads": heads})
    n = F.size("runs")
    rows = F.arrays_zip(starts.alias("start"), F.col("runs").alias("candidate"), F.slice(lefts, F.lit(1), n).alias("left"), F.slice(rights, F.lit(2), n).alias("right"))
    return split.select("doc_id", *keep, "path", F.explode(rows).alias("f")).select("doc_id", *keep, "path", F.col("f.start").cast("long").alias("start"), "f.candidate", "f.left", "f.right")


def _named() -> Column:
    """Whether the identifier before a run, or the word before that, is a keyword; blanks and marks count as underscores."""
    near = F.regexp_extract("left", r"((?:[\p{L}\p{N}_\-]+[^\p{L}\p{N}_\-]+)?[\p{L}\p{N}_\-]+)[^\p{L}\p{N}_\-]*$", 1)
    return F.regexp_replace(near, r"[^\p{L}\p{N}\-]+", "_").rlike(KEYWORDS)


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The ASCII words of four letters and more that most documents of ``docs(text)`` have, ``size`` of them, so few on the
    driver, and the fixed words."""
    words = F.array_distinct(F.filter(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,}"), F.lit(0)), lambda w: w.rlike("^[a-z]+$")))
    top = docs.select(F.explode(words).alias("w")).groupBy("w").count().where("count > 1").orderBy(F.desc("count"), "w").limit(size).collect()
    return sorted({r["w"] for r in top} | set(NAMING))


def _transitions(words: list[str]) -> list[float]:
    """Log-probabilities of a letter after another, from the dictionary's words, smoothed; 26 times 26."""
    pairs = Counter(pair for w in words for pair in zip(w, w[1:], strict=False))
    firsts = Counter(w[i] for w in words for i in range(len(w) - 1))
    letters = "abcdefghijklmnopqrstuvwxyz"
    return [log((pairs[a, b] + 0.5) / (firsts[a] + 13.0)) for a in letters for b in letters]


def with_features(findings: DataFrame, words: list[str]) -> DataFrame:
    """Findings with the forest's inputs: length, character transitions, dictionary coverage, path and neighbouring words.

    ``turns`` is the rate of changes of case and kind, ``bigrams`` the mean log-probability of its letters after each other
    in the dictionary's words; ``coverage`` is the share of characters in parts that are words. Of a path the inputs are whether it
    names tests, vendors or documents (``unreal``), or configuration (``real``), and its category, a hash of it.
    """
    c = F.col("candidate")
    n = F.greatest(F.char_length(c), F.lit(1)).cast("double")
    share = lambda pattern: 1.0 - F.char_length(F.regexp_replace(c, pattern, "")) / n
    turns = F.char_length(F.regexp_replace(c, r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])", "|")) - F.char_length(c)
    parts = F.transform(F.regexp_extract_all(c, F.lit("[A-Z]?[a-z]{3,}|[A-Z]{4,}"), F.lit(0)), F.lower)
    covered = F.aggregate(F.filter(parts, lambda w: w.isin(*words) if words else F.lit(False)), F.lit(0.0), lambda a, w: a + F.char_length(w))
    codes = F.transform(F.split(F.lower(c), ""), lambda x: F.ascii(x) - 97)
    letter = lambda x: x.between(0, 25)
    pairs = F.zip_with(codes, F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: F.when(letter(a) & letter(b), a * 26 + b))
    table = F.array(*map(F.lit, _transitions(words)))
    logs = F.transform(F.filter(pairs, lambda x: x.isNotNull()), lambda x: F.get(table, x))
    mean = F.aggregate(logs, F.lit(0.0), lambda a, x: a + x) / F.size(logs)
    yes = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    path = F.pmod(F.xxhash64("path"), F.lit(PATHS))
    return findings.withColumns({
        "length": n, "turns": turns / n, "bigrams": F.when(F.size(logs) > 0, mean).otherwise(F.lit(-log(26.0))), "digits": share("[0-9]"), "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "vowels": share("(?i)[aeiou]"), "coverage": covered / n, "keyword": yes(_named()), "assigned": yes(F.col("left").rlike(ASSIGNED)),
        "quoted": yes(F.col("left").rlike("[\"'`]$")), "prefix": yes(c.rlike(PREFIXES)), "unreal": yes(F.col("path").rlike(UNREAL)), "real": yes(F.col("path").rlike(REAL)),
    }).withColumns({f"path{i}": (path == i).cast("double") for i in range(PATHS)})


# What stands around planted values.
ASSIGNMENTS = [('token = "', '"'), ("API_KEY=", ""), ("password: ", ""), ('"client_secret": "', '"'), ("Authorization: Bearer ", ""), ("AWS_SECRET_ACCESS_KEY='", "'"), ("secret ", ""), ("passwd=", ";")]
MENTIONS = {
    "hash": [("commit ", ""), ("revision ", "."), ("sha1:", ""), ('checksum = "', '"'), ("sha256: ", ""), ("digest=", ""), ("etag: ", ""), ('public_key_fingerprint: "', '"'), ("author ", ""), ("auth_log_id=", "")], "uuid": [('id = "', '"'), ("request ", ""), ("uuid: ", ""), ("session=", "")],
    "path": [("file ", ""), ("see ", "."), ('path = "', '"'), ("import ", "")], "host": [("ab.12@", ""), ("https://", ""), ("host: ", ""), ("mail to x@", "")], "name": [("call ", "()"), ("", " = 1"), ("def ", ":"), ('key: "', '"'), ("author: ", ""), ("tokens in ", ".")],
    "number": [("number ", ""), ("card ", "."), ("id=", ""), ("", "")], "run": [("", ""), ("the ", "."), ("word: ", "")], "data": [("base64,", ""), ("image = ", ""), ("", "")], "bare": [("", ""), ("use ", "."), ("= ", "")],
}


def planted(docs: DataFrame, rows: int = PLANTED, seed: str = "planted", kinds: Callable[[int], bool] | None = None) -> DataFrame:
    """Labelled findings ``(doc_id, path, start, candidate, left, right, label)``, planted in the contexts of real documents.

    A hash draws about ``rows`` documents, or repeats those of a small table, up to 20 times each; in each a value of a
    drawn kind stands at a drawn word. Kinds labelled 1 are random keys, tokens and passwords, assigned to a telling name or
    with a known beginning. Kinds labelled 0 are what scanners take for them: hashes of commits and files, UUIDs, paths, mail
    and web hosts, identifiers, long numbers, run-together words, encoded data, and placeholders that are assigned to telling
    names. The label is the kind's, never a function of the forest's inputs. Findings stand in the document's source or in a file of
    it; files of tests, vendors and documents have few secrets, those of configuration many (PLACES). ``kinds`` says which numbers of
    kinds occur, so that others can be held out. Rows of one id are drawn apart by their texts.
    """
    n = max(1, docs.count())
    times = min(20, max(1, -(-rows // n)))
    unit = lambda what: F.pmod(F.xxhash64("doc_id", "rid", "copy", F.lit(seed), F.lit(what)), F.lit(1_000_003))
    many = docs.select("doc_id", F.xxhash64("text").alias("rid"), F.col("source").cast("string").alias("source"), F.coalesce("text", F.lit("")).alias("text"), F.explode(F.sequence(F.lit(1), F.lit(times))).alias("copy")).where(unit("row") < 1_000_003 * min(1.0, rows / (n * times)))
    near = F.substr("text", (unit("at") % F.greatest(F.lit(1), F.char_length("text") - CONTEXT)).cast("int") + 1, F.lit(2 * CONTEXT))
    placed = stage(many.select("doc_id", "rid", "source", "copy", near.alias("near")), "contexts").withColumns({
        "before": F.regexp_extract(F.left("near", F.lit(CONTEXT)), r"(?s)^(.*\s)?", 0), "after": F.regexp_extract(F.substr("near", F.lit(CONTEXT + 1)), r"(?s)\s.*$", 0),
        "words": F.regexp_extract_all(F.lower("near"), F.lit("[a-z]{3,9}"), F.lit(0)), "r": F.sha2(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("rid").cast("string"), "copy"), 512), "size": unit("size").cast("int"),
    }).withColumn("b64", F.base64(F.unhex("r"))).withColumn("alnum", F.regexp_replace("b64", "[+/=]", ""))
    r, alnum, size = F.col("r"), F.col("alnum"), F.col("size")
    word = lambda i: F.coalesce(F.try_element_at("words", F.lit(i)), F.lit(NAMING[i]))
    cut = lambda c, k: F.left(c, k if isinstance(k, Column) else F.lit(k))
    uuid = F.concat_ws("-", *[F.substr(r, F.lit(a), F.lit(k)) for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    some = lambda: F.element_at(F.array(*map(F.lit, NAMING)), unit("word").cast("int") % len(NAMING) + 1)
    random_keys = [cut(r, 40), cut(r, 32), cut("b64", 40), cut("b64", 24 + size % 40), cut(alnum, 18 + size % 14), cut(alnum, 32), uuid]
    known_keys = [F.concat(F.lit("AKIA"), F.upper(cut(alnum, 16))), F.concat(F.lit("ghp_"), cut(alnum, 36)), F.concat(F.lit("sk_live_"), cut(alnum, 24)), F.concat(F.lit("eyJ"), cut(alnum, 20), F.lit(".eyJ"), F.substr(alnum, F.lit(20), F.lit(40)), F.lit("."), F.substr(alnum, F.lit(30), F.lit(43)))]
    title = lambda c: F.initcap(c)
    decoys = {
        "hash": [cut(r, 40), cut(r, 64), cut(r, 32)], "uuid": [uuid],
        "path": [F.concat(F.lit("/usr/lib/"), word(1), F.lit("/"), word(2), F.lit("."), word(3)), F.concat_ws("/", F.lit("src"), word(4), word(5), F.concat(word(6), F.lit("_test.py"))), F.concat_ws(".", F.lit("com"), word(2), word(3), title(word(4)))],
        "host": [F.concat(F.lit("mail"), size % 9, F.lit(".example.com")), F.concat_ws(".", F.lit("www"), word(1), F.concat(word(2), F.lit("-"), word(3)), F.lit("org"))],
        "name": [F.concat(word(1), title(word(2)), title(word(3)), title(word(4))), F.concat_ws("_", word(1), word(2), word(3), some()), F.upper(F.concat_ws("_", some(), word(2), word(3), word(4))), F.concat_ws("-", word(3), word(2), word(5), (size % 100).cast("string"))],
        "number": [cut(F.translate(r, "abcdef", "394857"), 16 + size % 5)], "run": [F.concat(word(1), word(2), word(3), word(4), word(5))], "data": [F.concat(F.lit("iVBORw0KGgo"), "b64", "b64")],
    }
    fakes = [F.concat_ws("_", F.lit("your"), some(), F.lit("goes_here")), F.concat_ws("-", F.lit("example"), some(), word(2), F.lit("value")), F.repeat(F.lit("x"), 16 + size % 30), F.concat(F.lit("changeme"), title(word(1)), title(word(2))), F.concat_ws("_", F.lit("INSERT"), F.upper(some()), F.lit("PLEASE")), F.concat_ws(".", F.lit("config"), some(), word(1), some())]
    # every pair of a value and its surroundings is as likely as any other of its label
    good = [(v, t) for v in random_keys for t in ASSIGNMENTS] + [(v, t) for v in known_keys for t in (*ASSIGNMENTS[:3], *MENTIONS["bare"])]
    bad = [(v, t) for kind, values in decoys.items() for v in values for t in MENTIONS[kind]] + [(v, t) for v in fakes for t in ASSIGNMENTS]
    values = list({id(v): v for v, _ in good + bad}.values())
    number = {id(v): i for i, v in enumerate(values)}
    good, bad = ([x for x in own if kinds is None or kinds(number[id(x[0])])] for own in (good, bad))

    def plant(kinds: list) -> Column:
        literal = F.array(*[F.struct(F.lit(number[id(v)]).alias("number"), F.lit(t[0]).alias("open"), F.lit(t[1]).alias("close")) for v, t in kinds])
        return F.element_at(literal, unit("kind").cast("int") % len(kinds) + 1)

    places = F.array(*[F.struct(F.array(*map(F.lit, names)).alias("names"), F.lit(int(100 * share)).alias("percent")) for names, share in PLACES])
    place = F.element_at(places, unit("place").cast("int") % len(PLACES) + 1)
    source = F.concat(F.coalesce("source", F.lit("")), F.element_at(place["names"], unit("file").cast("int") % F.size(place["names"]) + 1))
    drawn = placed.select("doc_id", source.alias("source"), "before", "after", (unit("label") % 100 < place["percent"]).cast("double").alias("label"), F.array(*values).alias("values"), plant(good).alias("good"), plant(bad).alias("bad"))
    drawn = drawn.withColumn("plant", F.when(F.col("label") == 1.0, F.col("good")).otherwise(F.col("bad")))
    drawn = stage(drawn.select("doc_id", "source", "before", "after", "label", "plant", F.get("values", "plant.number").alias("value")), "plants")
    text = F.concat("before", "plant.open", "value", "plant.close", "after")
    whole = drawn.select("doc_id", "source", text.alias("text"), "label", (F.char_length("before") + F.char_length("plant.open")).alias("at"), F.char_length("value").alias("long"))
    hit = (F.col("start") < F.col("at") + F.col("long")) & (F.col("start") + F.char_length("candidate") > F.col("at"))
    return candidates(stage(whole, "planted_texts"), "label", "at", "long").where(hit).drop("at", "long")


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS, trees: int = 40, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest from findings with features and ``label``, about ``train_rows`` of them; None unless both labels occur."""
    rows = labelled.where("label is not null")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = shares(counts, train_rows)
    own = F.when(F.col("label") == 1.0, share[1.0]).otherwise(share[0.0])
    drawn = rows.withColumn("weight", 1 / own).where(F.pmod(F.xxhash64("candidate", "doc_id", "start"), F.lit(1_000_000_000)) / 1e9 < own)
    inputs = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(drawn).select("features", "label", "weight")
    return RandomForestClassifier(numTrees=trees, maxDepth=10, seed=seed, weightCol="weight").fit(inputs)


def score(findings: DataFrame, model: RandomForestClassificationModel | None, cut: float = 0.5) -> DataFrame:
    """Findings with ``score``, the forest's probability of a secret, and ``is_secret``; without a forest nothing is removed: all score ``cut``."""
    if model is None:
        return findings.withColumns({"score": F.lit(cut), "is_secret": F.lit(True)})
    probability: Column = vector_to_array("probability")[1]
    out = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(findings)).withColumn("score", probability)
    return out.withColumn("is_secret", F.col("score") >= cut)
