import re
from collections import Counter, defaultdict

import cases
from ledgerleaf.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def form(line):
    return "".join(c for c in line.lower().translate(str.maketrans("123456789", "0" * 9)) if c not in " \t\n\x0b\x0c\r")


def brute(rows, max_texts, min_texts, share, least):
    texts, hosts = defaultdict(set), defaultdict(set)
    for _, t, _, host, _ in rows:
        hosts[host].add(t or "")
        for x in (t or "").split("\n"):
            if WORD.search(x):
                texts[host, form(x)].add(t or "")
    out = {}
    for i, t, _, host, _ in rows:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        grams = Counter(tuple(w[a : a + 3]) for a in range(len(w) - 2))
        inside = {a + k for a in range(len(w) - 2) if grams[tuple(w[a : a + 3])] > 1 for k in range(3)}
        n_texts = lambda x: len(texts[host, form(x)])  # noqa: E731, B023
        gone = [x for x in lines if n_texts(x) > max_texts or n_texts(x) > min_texts and n_texts(x) > share * len(hosts[host])]
        removed = sum(len(WORD.findall(x)) for x in gone)
        failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        rest = "\n".join(x for x in t.split("\n") if x not in gone)
        out[i] = ((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside), failed, not failed and len(w) - removed >= least * len(w), removed), rest)
    return out


def test_counts_and_verdicts(spark):
    df, rows = cases.documents(spark, seed=4, n=80)
    want = brute(rows, 20, 1, 0.05, 0.5)
    got = {r.doc_id: tuple(r)[1:] for r in line_rules.judge(df, min_texts=1, share=0.05).collect()}
    assert got == {i: x[0] for i, x in want.items()}
    kept = {r.doc_id: r for r in line_rules.apply_rules(df, min_texts=1, share=0.05).collect()}
    assert {i: r.text for i, r in kept.items()} == {i: x[1] for i, x in want.items() if x[0][6]}
    assert line_rules.apply_rules(df).columns == df.columns


def test_copies_are_one_text_and_empty_tables(spark):
    text = "\n".join(" ".join(f"w{k}x{i}" for i in range(12)) for k in range(6))
    df = spark.createDataFrame([(i, text, "en", "h", 0) for i in range(40)] + [(None, text, None, None, None)] * 2, cases.SCHEMA)
    assert line_rules.judge(df).where("NOT kept OR removed_words > 0").count() == 0
    assert line_rules.apply_rules(df).count() == 42
    assert line_rules.judge(cases.empty(spark)).count() == line_rules.apply_rules(cases.empty(spark)).count() == 0


def test_depleted_documents_go(spark):
    menu = "\n".join(" ".join(f"menu{k}x{i}" for i in range(15)) for k in range(4))
    # but for digits the own lines are alike, in 20 texts: a limit of 20 leaves them
    rows = [(i, f"{menu}\n" + " ".join(f"own{i}x{j}" for j in range(10 if i == 0 else 200)), "en", "h", 0) for i in range(30)]
    got = {r.doc_id: (r.kept, r.removed_words) for r in line_rules.judge(spark.createDataFrame(rows, cases.SCHEMA), min_texts=20).collect()}
    assert got[0] == (False, 60) and got[1] == (True, 60)


def test_limits_of_small_and_large_hosts(spark):
    def text(host, i, shared):
        lines = [f"{x} of {host} is said here" for x, n in shared.items() if i < n]
        letters = str(1000 + i).translate(str.maketrans("0123456789", "abcdefghij"))
        return "\n".join([*lines, " ".join(f"own{letters}x{j}" for j in range(60))])

    # a line in 21 texts goes from a host of any size, one in 20 of 200 stays; 6 of 30 go, 5 of 30 stay
    held = {"large": (200, {"alpha": 21, "beta": 20}), "small": (30, {"gamma": 6, "delta": 5}), "tiny": (3, {"common": 3})}
    rows = [(100 * 100 * k + i, text(host, i, shared), "en", host, 0) for k, (host, (n, shared)) in enumerate(held.items()) for i in range(n)]
    kept = line_rules.apply_rules(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    assert len(kept) == len(rows)
    first = {host: [x.split()[0] for r in kept if r.source == host for x in r.text.split("\n")[:-1]] for host in held}
    assert {h: {x: v.count(x) for x in set(v)} for h, v in first.items()} == {"large": {"beta": 20}, "small": {"delta": 5}, "tiny": {"common": 3}}
    want = brute(rows, line_rules.MAX_TEXTS, line_rules.MIN_TEXTS, line_rules.SHARE, line_rules.LEAST_KEPT)
    assert {r.doc_id: tuple(r)[1:] for r in line_rules.judge(spark.createDataFrame(rows, cases.SCHEMA)).collect()} == {i: x[0] for i, x in want.items()}
