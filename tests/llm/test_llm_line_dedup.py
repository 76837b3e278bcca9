import random
import re

import llm_fixtures as fx
from tackroom.llm import line_dedup
from tackroom.llm.line_dedup import dedup_lines, removals


def tokens(line):
    return frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line) if w)


def brute(texts):
    """Line numbers to remove for each (id, text), ids distinct and not null."""
    seen, out = [], {}
    for d, text in sorted(texts):
        gone = []
        for i, line in enumerate((text or "").split("\n")):
            t = tokens(line)
            if t and any(5 * len(t & s) >= 4 * len(t | s) for s in seen):
                gone.append(i)
            if t:
                seen.append(t)
        out[d] = gone
    return out


def make(seed, n):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 25))] for _ in range(12)]
    texts = []
    for _ in range(n):
        lines = []
        for _ in range(rng.randrange(0, 7)):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(0, 3)):
                line[rng.randrange(len(line))] = f"e{rng.randrange(60)}"
            lines.append((rng.choice(["  ", "\t", " ", " ", " "])).join(line) + (rng.choice([" ", "\t", "\r"]) if rng.random() < .2 else ""))
        texts.append("\n".join(lines))
    return texts


def check(spark, texts):
    got = {r.doc_id: [int(x) for x in r.removed.split(",")] if r.removed else [] for r in removals(fx.docs(spark, texts)).collect()}
    assert got == brute(list(enumerate(texts)))


def test_against_brute_force(spark):
    check(spark, make(1, 60) + ["", None, "\n\n", "a", "a\na", "É\né", "A"])


def test_star_path_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "STAR", 2)
    check(spark, make(2, 60))


def test_texts_are_cut_and_columns_stay(spark):
    d = fx.docs(spark, ["keep me\nline two of it", "me keep\nthird", None, "line two of it", "x\n\nx"], [1, 2, 3, 4, 5])
    out = dedup_lines(d)
    assert out.columns == d.columns and out.schema["text"].dataType == d.schema["text"].dataType
    assert {r.doc_id: r.text for r in out.collect()} == {1: "keep me\nline two of it", 2: "third", 3: None, 4: "", 5: "x\n"}


def test_null_and_repeated_ids_and_empty_table(spark):
    d = fx.docs(spark, ["same line here", "same line here", "same line here", "other words entirely"], [1, 1, None, 1])
    got = sorted((str(r.doc_id), r.n_removed) for r in removals(d).collect())
    assert got == [("1", 0), ("1", 0), ("1", 0), ("None", 1)]  # repeated rows alike; a null id comes last
    assert removals(d.limit(0)).count() == 0


def test_long_lines_against_brute_force(spark):
    """Lines of 64 words and more have more parity bits; their partners may have fewer."""
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([58, 64, 66, 90, 200, 300]))] for _ in range(6)]
    texts = []
    for _ in range(70):
        line = list(rng.choice(base))
        for _ in range(rng.randrange(0, len(line) // 7)):
            line[rng.randrange(len(line))] = f"e{rng.randrange(900)}"
        texts.append(" ".join(line[rng.randrange(3):]) + "\nshort tail")
    check(spark, texts)


def test_words_are_made_once_and_one_exchange_serves_the_join(spark, monkeypatch):
    """Per line, its words are made once; the prefixes are dealt out once for both sides of one join, and no later table is made
    from them again, whatever the number of frequent words."""
    monkeypatch.setattr(line_dedup, "STAR", 4)
    plans, write = {}, line_dedup.materialize

    def recorded(df, name):
        df.collect()
        plans[name] = (df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)
    monkeypatch.setattr(line_dedup, "materialize", recorded)
    spark.conf.set("spark.sql.maxPlanStringLength", 1 << 24)
    check(spark, make(3, 80))
    spark.conf.unset("spark.sql.maxPlanStringLength")
    assert plans["line-sets"][0].count("array_distinct(") == 1
    final = plans["pairs"][1].split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("Generate posexplode(prefix") == 1
    assert [name for name, (plan, _) in plans.items() if "posexplode(prefix" in plan] == [
        "frequent-prefix-words", "earliest-lines", "first-pairs", "pairs"]
