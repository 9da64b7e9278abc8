"""Stages decide for rows, also where ids are missing or repeat."""

from collections import Counter

from flowlens.llm import exact, minhash, mix

_SCHEMA = "doc_id long, text string, source string"


def _long(seed, n=60):
    return " ".join(f"w{seed}x{k}" for k in range(n))


def test_exact_copies_without_or_with_repeated_ids(spark, docs):
    a, b = _long(1), _long(2)
    rows = [(None, a, "s")] * 5 + [(None, a.upper(), "t")] + [(1, b, "s")] * 3 + [(2, b, "s"), (2, a + " z", "s"), (3, None, "s")]
    got = [tuple(r) for r in exact.drop_copies(spark.createDataFrame(rows, _SCHEMA)).collect()]
    assert sorted((str(i), t) for i, t, _ in got if i is not None) == sorted([("2", b), ("2", a + " z"), ("3", None)], key=str)
    assert [t.lower() for i, t, _ in got if i is None] == [a]


def test_near_copies_without_or_with_repeated_ids(spark, docs):
    a, b, c, d = (_long(k) for k in range(4))
    rows = [(None, a, "s"), (None, a + " z", "s"), (None, a, "s"), (None, b, "s"), (1, c, "s"), (2, c + " z", "s"),
            (2, d, "s"), (2, d, "s"), (1, d + " z y", "t"), (3, "", "s"), (3, "", "s"), (4, None, "s")]
    got = Counter(tuple(r) for r in minhash.drop_near_duplicates(spark.createDataFrame(rows, _SCHEMA)).collect())
    assert max(got.values()) == 1
    texts = sorted(t for _, t, _ in got if t)
    assert len(texts) == 4 and texts[0] in (a, a + " z") and texts[1:] == [b, c, d + " z y"]
    assert sorted(i for i, t, _ in got if not t) == [3, 4]


def test_copies_of_the_mix_are_those_of_the_rows(spark, docs):
    rows = [(None, _long(k % 7, 20 + k % 3), "abc"[k % 3]) for k in range(300)] + [(5, _long(9), "a")] * 40
    rows += [(k, _long(k, 10 + k % 9), "abc"[k % 3]) for k in range(10, 200)]
    df = spark.createDataFrame(rows, _SCHEMA)
    want = Counter()
    for r in mix.mix_sources(df).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    got = Counter((r["doc_id"], r["source"], len(r["text"].split())) for r in mix.mixed_documents(df).collect())
    assert got == +want


def test_columns_of_any_type_and_name(spark, docs):
    """Map columns, dotted names and names like inner ones pass all stages that drop or repeat rows."""
    text = [_long(k % 9, 40 + k % 3) for k in range(60)]
    rows = [(k if k % 7 else None, t, "ab"[k % 2], {"k": k % 2}, k % 3, 1, 2, 3, [k % 2]) for k, t in enumerate(text)]
    rows += rows[:20] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, m map<string,int>, `a.b` int, "
                                     "__n int, __doc_id int, __row int, `n` array<int>")
    for f in (exact.drop_copies, minhash.drop_near_duplicates, mix.mixed_documents):
        out = f(df)
        assert out.columns == df.columns
        got = [(r["doc_id"], r["text"], r["source"], r["m"], r["a.b"], r["__n"], r["__doc_id"], r["__row"], r["n"]) for r in out.collect()]
        assert got and all(g in rows for g in got)
        if f is exact.drop_copies:
            # null never stays before an id; of rows without one a single row stays
            assert len(got) == len({t for _, t, *_ in rows})
        assert f(df.where("1 = 0")).count() == 0
        # equal rows are one document for the two that drop, and share their copies in the mix
        again = sorted(map(str, [tuple(r) for r in f(df).collect()]))
        assert again == sorted(map(str, [tuple(r) for r in out.collect()]))


def test_long_chains_are_followed_to_the_end(spark, docs):
    """A path of nodes, however long, is one component."""
    n = 3000
    edges = spark.createDataFrame([(k * 7919 % 100_003, (k + 1) * 7919 % 100_003) for k in range(n)], "a long, b long")
    got = [tuple(r) for r in minhash.connected(edges).collect()]
    low = min(k * 7919 % 100_003 for k in range(n + 1))
    assert len(got) == n + 1 and {r for _, r in got} == {low}
