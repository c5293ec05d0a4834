"""Filter interactions against applying the filters one after another."""

import re
from itertools import permutations

from vigil.llm import filter_audit

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def plain_failures(rows):
    """Letters that each row (doc_id, lang, text) fails."""
    out = []
    for i, _, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append(
            {
                letter for letter, bad in (
                    ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
                    ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))),
                    ("E", i is not None and any(j is not None and j < i and (t or "") == text for j, _, t in rows)),
                ) if bad
            }
        )
    return out


def plain_audit(rows, labels):
    failures = plain_failures(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for part in {lang or "" for _, lang, _ in rows}:
        own = [(i, f) for (i, lang, _), f in zip(rows, failures) if (lang or "") == part]
        share, steps = {x: 0 for x in "ABCDE"}, []
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if letter in x[1]]
                earlier = sum(letter in f for _, f in own) - len(removed)
                left = [x for x in left if letter not in x[1]]
                share[letter] += len(removed)
                steps.append([
                    part, order, step, len(left), len(removed), earlier, sum(f == {letter} for _, f in own),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed),
                ])
        out += [(*s, share[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def test_every_order_and_step(spark):
    long = " ".join(f"w{i}" for i in range(100))
    texts = [
        None, "", " \n", long, long, long + " $", "w " * 100, " ".join(["A"] * 99), "AB" + "c" * 18, "ABC" + "c" * 18,
        " ".join(f"w{i % 80}" for i in range(100)), " ".join(f"w{i % 79}" for i in range(100)), "É" * 50, long.upper(), "x\x0by\x1cz #",
    ]
    rows = [(i, ["en", "de", None, ""][i % 4], t) for i, t in enumerate(texts)]
    rows += [(4, "en", long), (3, "fr", long), (None, "en", long), (None, None, ""), (20, "en", long), (20, "en", long)]
    labels = [(i, i % 2, i % 3) for i in range(0, 21, 2)] + [(3, 1, 1), (3, 0, None), (4, None, 0), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], "doc_id bigint, lang string, text string, mask int, part string, `a.b` string")
    marked = spark.createDataFrame([(*r, 1) for r in labels], "doc_id bigint, quality int, toxic int, n int")
    columns = ["part", "filter_order", "step", *COUNTS, "shapley"]
    got = sorted(tuple(r) for r in filter_audit.audit(docs, marked).select(columns).collect())
    assert got == plain_audit(rows, labels)
    assert filter_audit.audit(docs.filter("false"), marked).count() == 0
    unlabelled = filter_audit.audit(docs, marked.filter("false")).agg({"good_lost": "sum", "removed": "sum"}).first()
    assert unlabelled["sum(good_lost)"] == 0 < unlabelled["sum(removed)"]
