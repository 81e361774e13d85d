"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are private key blocks, values assigned to a word like password or token, and long runs
of key characters with a digit in them. A candidate is described by its length, the changes between
character classes, the pairs of letters that are common in words, the share covered by dictionary
words, signs of paths, hosts and file names, and the words next to it. A random forest, trained by
Spark on labelled findings, votes; candidates with at least half of the votes are secrets.

Everything is a Column expression inside the document's row: candidates, features and votes are
arrays, so nothing is shuffled, joined or collected, and no hot source matters. The trained forest
is written out as an expression.

Cases: null and empty texts have no findings. Rows come back as often as they came in. A document
with very many candidates costs time that grows a little faster than their number, as offsets are
summed inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.trees import train_trees, votes

KEY = r"A-Za-z0-9+/_=.~\-"
NAMES = r"pass(?:word|wd|phrase)?|pwd|secret|token|credentials?|auth|(?:api|access|private|signing)[_\- ]?key"
ASSIGNED = rf"(?i:(?<![A-Za-z])(?:{NAMES})[\"']?\s{{0,3}}[:=]{{1,2}}\s{{0,3}}[\"']?)"
VALUE = r"[^\s\"'<>,;]{6,}"
BLOCK = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,30}PRIVATE KEY-----)?"
RUN = rf"(?<![{KEY}])(?=[{KEY}]*[0-9])[{KEY}]{{16,}}+"
CANDIDATE = f"{BLOCK}|{ASSIGNED}{VALUE}|{RUN}"
BEFORE, AFTER = 40, 20
THRESHOLD = 0.5
TREES, DEPTH = 25, 6
MASK = "[SECRET]"

# Words that keys do not consist of.
DICTIONARY = (
    "account address admin amount apple article author background banner blank book button change city client code"
    " color comment common config content count country create customer data date default delete demo detail device"
    " document domain download email entry error event example file first folder form group header hello home host"
    " image index info input invoice issue item label language letter level library license link list local login mail"
    " main manager market member message method model module month name network news node note number object option"
    " order output owner package page param parent part party path person phone photo picture place placeholder plan"
    " point post price print product profile project public query range record region release report request result"
    " review sample screen search section select server service session setting shop simple size source space start"
    " state static status store string style subject summary system table target task test text theme time title total"
    " type update upload user value version video view web week window word work year your"
).split()
COMMON_PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur".split()
SECRET_WORDS = NAMES + r"|bearer|authorization|key"
PLAIN_WORDS = (
    r"commit|sha|checksum|digest|md5|uuid|guid|revision|build|version|isbn|card|phone|order|invoice|etag|hash|file|path"
    r"|example|sample|placeholder|dummy|image|license|see"
)


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def features(before: Column, value: Column, after: Column) -> Column:
    """Numbers that describe a candidate, as array<double>."""
    size = F.length(value)
    count = lambda pattern: F.regexp_count(value, F.lit(pattern))
    covered = size - F.length(F.regexp_replace(F.lower(value), "|".join(DICTIONARY), ""))
    changes = count(r"[a-z](?=[^a-z])") + count(r"[A-Z](?=[^A-Z])") + count(r"[0-9](?=[^0-9])")
    pairs = count("(?i)(?=" + "|".join(COMMON_PAIRS) + ")")
    near = F.substring(before, -16, 16)
    return F.array(
        size.cast("double"),
        _share(changes, size),
        _share(count("[0-9]"), size),
        _share(count("[A-Z]"), size),
        _share(count("[a-z]"), size),
        _share(pairs, size),
        _share(covered, size),
        F.size(F.array_distinct(F.split(value, ""))).cast("double"),
        _share(count(r"[/.]"), size),
        count(r"[_\-]").cast("double"),
        F.rlike(value, F.lit(r"^(?:[0-9a-f]+|[0-9A-F]+)$")).cast("double"),
        F.rlike(value, F.lit(r"\.(?:[a-z]{2,4}|json|html|jpeg)$")).cast("double"),
        F.rlike(near, F.lit(rf"(?i)(?:{SECRET_WORDS})\W{{0,8}}$")).cast("double"),
        F.rlike(near, F.lit(rf"(?i)\b(?:{PLAIN_WORDS})\W{{0,8}}$")).cast("double"),
        F.rlike(before, F.lit(r"[@/:.]$")).cast("double"),
        F.rlike(before, F.lit(r"[:=]\s*[\"']?$")).cast("double"),
        F.rlike(after, F.lit(r"^[\"']")).cast("double"),
        F.rlike(value, F.lit(r"^(?:AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk[-_]|pk[-_]|eyJ|AIza|glpat-|-----BEGIN)")).cast("double"),
    )


def labelled_findings(spark: SparkSession, each: int = 30) -> DataFrame:
    """(``before``, ``value``, ``after``, ``label``) built by rule: keys in the places where keys
    stand, and what looks like keys but is none. ``each`` rows per kind."""
    i = F.col("id").cast("string")
    hex40 = F.sha1(F.concat(F.lit("a"), i))
    hex64 = F.sha2(F.concat(F.lit("b"), i), 256)
    hex32 = F.md5(F.concat(F.lit("c"), i))
    mixed = lambda tag, n: F.substring(
        F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit(tag), i), 512))), "[+/=]", "x"), 1, n
    )
    digits = lambda tag, n: F.substring(F.regexp_replace(F.sha2(F.concat(F.lit(tag), i), 512), "[a-f]", ""), 1, n)
    word = lambda k: F.get(F.array(*[F.lit(w) for w in DICTIONARY]), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(DICTIONARY))).cast("int"))
    of = lambda words: F.get(F.array(*[F.lit(w) for w in words]), F.pmod(F.xxhash64("id"), F.lit(len(words))).cast("int"))
    assign = of(['token = "', "api_key: ", 'SECRET="', "access_key=", 'TOKEN = "', "auth: "])
    quote = F.lit('" ')
    blank = F.lit(" ")
    kinds = [
        (assign, hex40, quote, 1), (assign, hex64, quote, 1), (assign, hex32, quote, 1), (assign, F.upper(hex40), quote, 1),
        (assign, mixed("d", 40), quote, 1), (assign, mixed("e", 24), blank, 1), (of(["Bearer ", "key ", "with "]), mixed("f", 48), blank, 1),
        (of(["id ", "with ", ""]), F.concat(F.lit("AKIA"), F.upper(F.substring(hex64, 1, 16))), blank, 1),
        (of(["use ", "is ", ""]), F.concat(F.lit("ghp_"), mixed("g", 36)), blank, 1),
        (of(["use ", "is ", ""]), F.concat(F.lit("sk-"), mixed("h", 40)), blank, 1),
        (of(["password: ", "pwd=", 'passwd = "']), F.concat(mixed("i", 9), F.lit("!"), digits("j", 2)), blank, 1),
        (of(["the ", "from ", "in "]), mixed("k", 44), blank, 1),
        (of(["cookie ", "jwt ", ""]), F.concat(F.lit("eyJ"), mixed("m", 30), F.lit("."), mixed("n", 40), F.lit("."), mixed("o", 43)), blank, 1),
        (F.lit(""), F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), mixed("p", 60), F.lit("\n-----END PRIVATE KEY-----")), blank, 1),
        (of(["commit ", "sha1 ", "checksum ", "digest: "]), hex40, blank, 0), (of(["sha256:", "etag ", "hash "]), hex64, blank, 0),
        (of(["md5 ", "build ", "checksum: "]), hex32, blank, 0),
        (of(["uuid ", "guid: ", "order "]), F.concat_ws("-", F.substring(hex32, 1, 8), F.substring(hex32, 9, 4), F.substring(hex32, 13, 4), F.substring(hex32, 17, 4), F.substring(hex32, 21, 12)), blank, 0),
        (of(["card ", "in ", "the ", "les "]), digits("q", 16), blank, 0), (of(["phone ", "call ", "no "]), F.concat(F.lit("00"), digits("r", 16)), blank, 0),
        (of(["34@", "user.55@", "at "]), F.concat(F.lit("mail"), digits("s", 1), F.lit(".example.com")), blank, 0),
        (of(["//", "see ", "on "]), F.concat(F.lit("www."), word(1), word(2), digits("s", 2), F.lit(".org/"), word(3)), blank, 0),
        (of(["in /", "file ", "path "]), F.concat(F.lit("usr/"), word(4), F.lit("/"), word(5), F.lit("-1."), digits("t", 2), F.lit(".txt")), blank, 0),
        (of(["see ", "image ", ""]), F.concat(word(6), F.lit("_"), word(7), F.lit("_"), digits("u", 4), F.lit(".jpeg")), blank, 0),
        (of(['token = "', "api_key: ", "password="]), F.concat(F.lit("your_"), word(8), F.lit("_"), word(9), F.lit("_"), digits("v", 2)), quote, 0),
        (of(['token = "', "secret: "]), F.concat(F.repeat(F.lit("x"), 20), digits("w", 1)), quote, 0),
        (of(["call ", "the ", ""]), F.concat(word(10), F.lit("-"), word(11), F.lit("-"), word(12), F.lit("-"), digits("x", 3)), blank, 0),
        (of(["on ", "since "]), F.concat(F.lit("2024-0"), digits("y", 1), F.lit("-1"), digits("z", 1), F.lit("T1"), digits("A", 1), F.lit(".00.00")), blank, 0),
        (of(["version ", "build "]), F.concat(word(13), F.lit("-1."), digits("B", 1), F.lit("."), digits("C", 2), F.lit("-release")), blank, 0),
        (of(["password: ", "token: ", "auth = "]), F.concat(F.lit("get"), word(14), F.lit("."), word(15)), blank, 0),
    ]
    shape = lambda b, v, a, y: F.struct(b.alias("before"), v.alias("value"), a.alias("after"), F.lit(y).alias("label"))
    rows = spark.range(each).select(F.explode(F.array(*[shape(*k) for k in kinds])).alias("r"))
    return rows.select(F.concat(F.lit("the on "), "r.before").alias("before"), "r.value", "r.after", "r.label")


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> list:
    """A forest from (``before``, ``value``, ``after``, ``label``)."""
    rows = findings.select(features(F.col("before"), F.col("value"), F.col("after")).alias("features"), "label")
    return train_trees(rows, "features", "label", trees, depth)


def with_findings(documents: DataFrame, forest: list, text: str = "text", name: str = "findings") -> DataFrame:
    """Add an array of (``start``, ``length``, ``value``, ``score``), one per candidate, in order.
    Starts count code points from 0."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    scanned = documents.withColumns(
        {"_between": F.split(whole, CANDIDATE), "_matches": F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0))}
    )
    between, matches = F.col("_between"), F.col("_matches")
    # Ends of the matches before each match, and its own.
    ends = F.aggregate(
        F.sequence(F.lit(0), F.size(matches) - 1),
        F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("ends")),
        lambda a, i: F.struct(
            (a["end"] + F.length(F.get(between, i)) + F.length(F.get(matches, i))).alias("end"),
            F.array_append(
                a["ends"], a["end"] + F.length(F.get(between, i)) + F.length(F.get(matches, i))
            ).alias("ends"),
        ),
        lambda a: a["ends"],
    )
    lead = lambda m: F.when(
        F.rlike(m, F.lit(f"^{ASSIGNED}")), F.regexp_extract(m, f"^({ASSIGNED})", 1)
    ).otherwise(F.lit(""))
    cut = F.transform(
        F.arrays_zip(matches.alias("match"), F.col("_ends").alias("end")),
        lambda c, i: F.struct(
            c["match"].alias("match"), lead(c["match"]).alias("lead"), c["end"].alias("end"),
            F.get(between, i).alias("left"), F.get(between, i + 1).alias("right"),
        ),
    )
    valued = F.transform(
        F.col("_cut"),
        lambda c: F.struct(
            F.regexp_replace(F.substr(c["match"], F.length(c["lead"]) + 1), r"[.=]{1,3}$", "").alias("value"),
            F.concat(F.substring(c["left"], -BEFORE, BEFORE), c["lead"]).alias("before"),
            F.substring(c["right"], 1, AFTER).alias("after"),
            (c["end"] - F.length(c["match"]) + F.length(c["lead"])).alias("start"),
        ),
    )
    described = F.transform(
        F.col("_valued"),
        lambda c: F.struct(
            c["start"].alias("start"), c["value"].alias("value"), features(c["before"], c["value"], c["after"]).alias("f")
        ),
    )
    scored = F.transform(
        F.col("_described"),
        lambda c: F.struct(
            c["start"].cast("long").alias("start"), F.length(c["value"]).cast("long").alias("length"),
            c["value"].alias("value"), votes(forest, c["f"]).alias("score"),
        ),
    )
    none = F.array().cast("array<int>")
    steps = scanned.withColumn("_ends", F.when(F.size(matches) > 0, ends).otherwise(none))
    steps = steps.withColumn("_cut", cut).withColumn("_valued", valued).withColumn("_described", described)
    return steps.withColumn(name, scored).drop("_between", "_matches", "_ends", "_cut", "_valued", "_described")


def findings(documents: DataFrame, forest: list, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per candidate: id, ``start``, ``length``, ``value``, ``score``, ``secret``."""
    rows = with_findings(documents.select(doc_id, text), forest, text, "_found")
    rows = rows.select(F.col(doc_id), F.explode("_found").alias("f"))
    return rows.select(doc_id, "f.*", (F.col("f.score") >= THRESHOLD).alias("secret"))


def redacted(documents: DataFrame, forest: list, text: str = "text", mask: str = MASK) -> DataFrame:
    """Documents with the secrets in their text replaced by ``mask``; other texts stay as they are."""
    rows = with_findings(documents, forest, text, "_found")
    bad = F.filter("_found", lambda f: f["score"] >= THRESHOLD)
    done = F.aggregate(
        F.col("_bad"),
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda a, f: F.struct(
            (f["start"] + f["length"]).alias("at"),
            F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"), (f["start"] - a["at"]).cast("int")), F.lit(mask)).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substr(F.col(text), (a["at"] + 1).cast("int"))),
    )
    rows = rows.withColumn("_bad", bad)
    rows = rows.withColumn("_text", F.when(F.size("_bad") > 0, done).otherwise(F.col(text)))
    kept = [F.col("_text").alias(text) if c == text else F.col(c) for c in documents.columns]
    return rows.select(*kept)
