"""Personal data: fixed patterns, and bootstrapped contextual extraction, natively in Spark.

E-mail and IP addresses, card and phone numbers are found by their form, and so are secrets:
long runs of mixed digits and letters, and what is assigned to a name like token or key. These
seeds induce lexical patterns: the two words before them, and the word before, the word after
or both together with the identifier's shape. Patterns and the identifiers seen with
them are the two sides of a graph that Spark scores in turns: a pattern is worth the share of its
identifiers that are known or believed, an identifier is believed as far as its patterns are
worth it. Seeds, and identifiers that stand in a pattern of high score, support the patterns of
the next turn, until nothing is added. Patterns that end with enough support and a high score tag
the unseen identifiers that stand in them.

Only mentions are shuffled, never texts. One row of its own keeps every document in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.stores import Store, quoted, spare

KINDS = ["email", "ip", "card", "phone"]
SECRET = "secret"
# Each finds, left to right, what the kind's form describes. A possessive quantifier gives
# nothing back, and a match may begin inside a run of its characters only where the previous
# match ended, so the time is linear in the text.
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # What may be an identifier of another form: a run without white space that has a digit, @
    # or _, or begins with letters around a point or hyphen.
    "token": r"(?<!\S)(?=[^\s0-9@_]*+[0-9@_]|\p{L}++[.-]\p{L})\S++",
}
NEEDS = {"email": "@", "phone": "+"}  # without it a text has no match
TOKEN_LENGTH = (3, 128)
RUN_LENGTH = 256  # of a candidate with the name, quotes and points around it
# A name that secrets are assigned to, and what may stand around a candidate in its run.
NAME = r"(?:[\p{L}0-9]+[_.-])*(?:api|access|private|secret|auth)?(?:token|key|secret|password|passwd|pwd|credential)s?"
OPENS, CLOSES = r"""["'(\[{<]*""", r"""(?:"\S*|["')\]}>,;:.!?]*)\z"""
LEAD = rf"""(?i)^{OPENS}(?:({NAME}["']?[=:]){OPENS})?"""
ASSIGNED = rf"""(?i)(?<!\p{{L}}){NAME}["']?\s?[=:]\z"""
SECRET_LENGTH = (8, 32)  # at least, where it is assigned and where only its form tells
CONTEXT_CHARS = 80
TURNS = 3  # at least
LEAST_SEEDS = 5  # different seeds or sure identifiers, before a pattern may tag anything
PRIOR = 1.0  # unknown identifiers that every pattern is charged with
SURE = 0.8


def _mentions(text: Column, kind: str) -> Column:
    """Every match of a form: its number, the length of what lies before it since the previous
    match, itself, up to two words before it and the word after it."""
    form = F.lit(FORMS[kind])
    found = F.regexp_extract_all(text, form, F.lit(0))
    if kind in NEEDS:
        found = F.when(F.contains(text, F.lit(NEEDS[kind])), found)
    between = F.when(F.size(found) > 0, F.split(text, FORMS[kind], -1))
    n = F.size(found)
    pairs = F.zip_with(found, F.slice(between, 1, n), lambda m, b: F.struct(m.alias("m"), b.alias("b")))
    triples = F.zip_with(pairs, F.slice(between, 2, n), lambda r, a: F.struct(r["m"].alias("m"), r["b"].alias("b"), a.alias("a")))
    rows = F.transform(
        triples,
        lambda r, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(r["b"]).cast("bigint").alias("gap"), r["m"].alias("value"),
            _alike(F.regexp_extract(F.right(r["b"], F.lit(CONTEXT_CHARS)), rf"(?<!\S)((?:\S++\s++)?\S++)\s*+{OPENS}\z", 1)).alias("left"),
            _alike(F.regexp_extract(F.left(r["a"], F.lit(CONTEXT_CHARS)), r"\A\S*+\s++(\S++)", 1)).alias("right"),
        ),
    )
    return F.coalesce(rows, F.array())


def _alike(words: Column) -> Column:
    """Words of a context with case, numbers and most punctuation made alike."""
    one = F.regexp_replace(F.regexp_replace(F.lower(words), "[0-9]+", "0"), r"[\p{P}\p{S}&&[^=:]]+", ".")
    return F.regexp_replace(one, r"\s+", " ")


def _shape(value: Column) -> Column:
    """An identifier's form: runs of letters a, of digits 0, of eight digits or more #, of many such runs x."""
    digits = F.regexp_replace(F.regexp_replace(value, "[0-9]{8,}", "#"), "[0-9]+", "0")
    return F.regexp_replace(F.regexp_replace(digits, r"\p{L}+", "a"), "[a0#]{3,}", "x")


def patterns_of(left: Column, right: Column, value: Column) -> Column:
    """The lexical patterns that a mention stands in."""
    last = F.element_at(F.split(left, " "), -1)
    slot = F.concat(F.lit(" <"), _shape(F.left(value, F.lit(TOKEN_LENGTH[1]))), F.lit("> "))
    return F.array_compact(
        F.array(
            F.when(F.contains(left, F.lit(" ")), F.concat(left, F.lit(" <>"))),
            F.when((left != "") & (right != ""), F.concat(last, slot, right)),
            F.when(left != "", F.concat(last, slot)),
            F.when(right != "", F.concat(slot, right)),
        )
    )


def is_secret(value: Column, named: Column) -> Column:
    """Whether a candidate is a secret by its form, or by its name and less of a form."""
    digit_runs = F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)))
    kinds = F.size(F.array_distinct(F.split(value, "")))
    hexed = value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$") & (kinds >= 8)
    based = value.rlike("^[A-Za-z0-9+/_-]+={0,2}$") & value.rlike("[a-z]") & value.rlike("[A-Z]") & (kinds >= 16)
    by_form = (F.length(value) >= SECRET_LENGTH[1]) & (digit_runs >= 3) & (hexed | based)
    by_name = named & (F.length(value) >= SECRET_LENGTH[0]) & (digit_runs >= 1) & value.rlike(r"\p{L}")
    return by_form | by_name


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right; digits is not empty."""
    n = F.length(digits)
    each = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(each, F.lit(0), lambda acc, d: acc + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    count = F.length(digits)
    part = F.forall(
        F.split(value, r"\."),
        lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255),
    )
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", part)
        .when(kind == "card", count.between(14, 19) & luhn(F.when(count.between(14, 19), digits).otherwise("1")))
        .when(kind == "phone", count.between(10, 15))
        .otherwise(F.length(value) <= RUN_LENGTH)
    )


def mentions(docs: DataFrame, store: Store, id_col: str, text_col: str) -> DataFrame:
    """Stored rows (_row, doc_id, text_key, kind, start, end, value, left, right); kind is null in
    the one row that every document has. Candidates have the kind token, or secret if they are
    one, and lie without the name, quotes and points around them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
        F.md5(text).alias("text_key"), text.alias("text"),
    )
    blank = F.array(
        F.struct(
            F.lit(None).cast("string").alias("kind"), F.lit(0).alias("i"), F.lit(0).cast("bigint").alias("gap"),
            F.lit("").alias("value"), F.lit("").alias("left"), F.lit("").alias("right"),
        )
    )
    rows = own.select("_row", "doc_id", "text_key", F.inline(F.concat(blank, *[_mentions(F.col("text"), k) for k in FORMS])))
    before = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(before)
    placed = rows.withColumn("end", end).filter(F.col("kind").isNull() | _valid(F.col("kind"), F.col("value")))
    token = F.col("kind") == "token"
    lead = F.when(token, F.length(F.regexp_extract("value", LEAD, 0))).otherwise(0)
    cut = placed.withColumn("start", F.col("end") - F.length("value") + lead).withColumn(
        "named", token & ((F.regexp_extract("value", LEAD, 1) != "") | F.col("left").rlike(ASSIGNED))
    ).withColumn("value", F.substring(F.col("value"), lead + 1, F.length("value")))
    tail = F.when(token, F.length(F.regexp_extract(F.right("value", F.lit(16)), CLOSES, 0))).otherwise(0)
    core = cut.withColumn("end", F.col("end") - tail).withColumn("value", F.substring(F.col("value"), F.lit(1), F.length("value") - tail))
    return store.keep(
        core.filter(F.col("kind").isNull() | (F.col("kind") != "token") | F.length("value").between(*TOKEN_LENGTH))
        .withColumn("kind", F.when(token & is_secret(F.col("value"), F.col("named")), F.lit(SECRET)).otherwise(F.col("kind")))
        .select("_row", "doc_id", "text_key", "kind", "start", "end", "value", "left", "right"),
        "mentions",
    )


def pattern_scores(edges: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns (pattern, kind, seeds, score) and of unseen identifiers (value, kind,
    sure, score) after turns over the graph of distinct (pattern, value, kind) edges.

    `kind` is null for identifiers that are not seeds. A value that is a seed anywhere is one.
    `seeds` counts seeds and sure identifiers. Patterns and scores only grow from turn to turn,
    so the turns end.
    """
    edges = store.keep(edges.distinct(), "edges")
    known = edges.filter("kind is not null").select("value", "kind").distinct()
    size = edges.groupBy("pattern").agg(F.countDistinct("value").alias("n"))
    believed = seeds = known.withColumn("score", F.lit(1.0)).withColumn("seed", F.lit(1))
    links = edges.select("pattern", "value").distinct()
    turn, before = 0, None
    while True:
        turn += 1
        patterns = store.keep(
            links.join(believed, "value")
            .groupBy("pattern", "kind").agg(F.sum("score").alias("s"), F.sum("seed").alias("seeds"))
            .filter(F.col("seeds") >= LEAST_SEEDS)
            .join(size, "pattern")
            .select("pattern", "kind", "seeds", (F.col("s") / (F.col("n") + PRIOR)).alias("score")),
            f"patterns-{turn}",
        )
        unseen = store.keep(
            links.join(patterns, "pattern")
            .join(known.select("value").distinct(), "value", "left_anti")
            .groupBy("value", "kind")
            .agg(
                (F.max("score") >= SURE).cast("int").alias("sure"),
                (1 - F.exp(F.sum(F.log(1 - F.least(F.col("score"), F.lit(0.999)))))).alias("score"),
            ),
            f"unseen-{turn}",
        )
        # Nothing is added and scores have settled to a thousandth.
        worth = patterns.agg(F.count("*"), F.count(F.when(F.col("score") >= SURE, 1)), F.sum("score")).first()
        now = (*worth[:2], unseen.filter("sure = 1").count(), worth[2] or 0.0)
        if turn >= TURNS and now[:3] == before[:3] and now[3] - before[3] < 0.001:
            return patterns, unseen
        before = now
        believed = seeds.unionByName(unseen.withColumnRenamed("sure", "seed"))


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, text_key (md5 of the text), base and spans.

    Both are arrays of struct(start, rank, end, kind), ascending, in code points, end
    exclusive: `base` are the e-mail and IP addresses, card and phone numbers, `spans` have the
    secrets and the discovered identifiers too. Discovered ones never overlap a base span.
    Null texts count as empty. Rows that repeat, or share an id, or have none, are searched one
    by one; other columns are not read.
    """
    store = Store(docs.sparkSession, "pii")
    seen = mentions(docs, store, id_col, text_col)
    base = seen.filter(F.col("kind").isin(KINDS))
    other = seen.filter("kind = 'token'")
    taken = base.select("_row", F.col("start").alias("s"), F.col("end").alias("e"))
    free = store.keep(
        other.join(
            taken, (other["_row"] == taken["_row"]) & (taken["s"] < other["end"]) & (taken["e"] > other["start"]), "left_anti"
        )
        .withColumn("pattern", F.explode_outer(patterns_of(F.col("left"), F.col("right"), F.col("value")))),
        "free",
    )
    seeds = seen.filter(F.col("kind").isin(KINDS + [SECRET])).select(
        F.explode(patterns_of(F.col("left"), F.col("right"), F.col("value"))).alias("pattern"), "value", "kind"
    )
    edges = seeds.union(free.select("pattern", "value", F.lit(None).cast("string"))).filter("pattern is not null")
    patterns, unseen = pattern_scores(edges, store)
    sure = patterns.filter(F.col("score") >= SURE).select("pattern", "kind")
    new = (
        free.drop("kind").join(sure, "pattern")
        .join(unseen.filter(F.col("score") >= SURE).select("value", "kind"), ["value", "kind"])
        .select("_row", "doc_id", "text_key", "kind", "start", "end")
    )
    every = seen.filter("kind is null or kind <> 'token'").select(
        "_row", "doc_id", "text_key", "kind", "start", "end", F.col("kind").isin(KINDS).alias("seed")
    ).unionByName(new.withColumn("seed", F.lit(False)))
    rank = F.array_position(F.array(*map(F.lit, KINDS + [SECRET])), F.col("kind"))
    span = F.when(F.col("kind").isNotNull(), F.struct("start", rank.alias("rank"), "end", "kind"))
    return every.groupBy("_row", "doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.when(F.col("seed"), span))).alias("base"),
        F.array_sort(F.collect_set(span)).alias("spans"),
    ).drop("_row")


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by <kind>."""
    whole = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(
                    acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                    F.lit("<"), s["kind"], F.lit(">"),
                ).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
    )
    rest = F.substring(text, (whole["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) > 0, F.concat(whole["out"], rest)).otherwise(text)


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with personal data masked in the text; all rows and all other columns stay.

    What is masked depends on the text alone, so rows are matched by its md5. Null stays null.
    """
    key, found_col = spare(docs, "text_key"), spare(docs, "spans")
    spans = (
        found_spans(docs, id_col, text_col).filter(F.size("spans") > 0)
        .groupBy(F.col("text_key").alias(key)).agg(F.first("spans").alias(found_col))
    )
    keyed = docs.withColumn(key, F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    found = F.coalesce(found_col, F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>"))
    return (
        keyed.join(spans, key, "left")
        .withColumn(text_col, masked(F.col(text_col), found))
        .select(quoted(docs.columns))
    )
