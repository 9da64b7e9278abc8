from collections import Counter, defaultdict

from pyspark.sql import functions as F

from flowlens.llm import exact, mix, shard

from . import brute


def _by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_exact_matches_brute_force(docs, rows):
    got = _by_id(exact.exact_groups(docs), "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact([(i, t) for i, t, *_ in rows])


def test_exact_on_odd_rows(odd, odd_rows, none):
    got = exact.exact_groups(odd).collect()
    assert len(got) == len(odd_rows)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert by[1][0]["keep_id"] == by[2][0]["keep_id"] == 2 and by[1][0]["group_size"] == 2
    assert by[4][0]["keep_id"] == 5 and by[5][0]["kept"]
    assert not by[8][0]["kept"] and by[9][0]["kept"]
    assert [(r["group_size"], r["kept"]) for r in by[12]] == [(2, True)] * 2
    assert by[None][0]["kept"] and by[6][0]["group_size"] == 1
    assert exact.exact_groups(none).count() == 0


def test_digest_collisions_keep_texts_apart(docs, monkeypatch):
    """With a digest of two values nearly all chunks collide; the result is the same."""
    want = sorted(map(tuple, exact.exact_groups(docs).collect()))
    real = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(2)))
    assert sorted(map(tuple, exact.exact_groups(docs).collect())) == want


def test_drop_copies_keeps_columns(docs):
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == exact.exact_groups(docs).where("kept").count()


def test_shards_match_brute_force(docs, rows):
    got = _by_id(shard.interleave_shards(docs, 40), "size", "text_crc32", "shard", "slot")
    assert got == brute.interleave([r[:3] for r in rows], 40, shard.SEED)


def test_shards_follow_the_mixture(docs, rows):
    got = _by_id(shard.interleave_shards(docs, 8), "shard")
    source = {i: s for i, _, s, _ in rows}
    n = Counter(source.values())
    cells = Counter((source[i], s) for i, (s,) in got.items())
    counts = Counter(s for (s,) in got.values())
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(abs(cells[s, k] - n[s] / 8) <= 2 for s in n for k in range(8))


def test_shards_on_odd_rows(odd, odd_rows, none):
    got = shard.interleave_shards(odd, 40).collect()
    assert len(got) == len(odd_rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert shard.interleave_shards(none, 40).count() == 0


def test_mix_rates_and_totals(docs, rows):
    got = mix.mix_sources(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    words = {i: len(brute.WORD.findall(t or "")) for i, t, *_ in rows}
    sizes = {s: sum(words[r["doc_id"]] for r in g) for s, g in by.items()}
    want = brute.targets(sizes, mix.WEIGHTS, mix.SHARE, mix.CAP)
    for s, g in by.items():
        own = [r["size"] for r in g]
        assert own == [words[r["doc_id"]] for r in g]
        assert abs(g[0]["target"] - want[s]) <= 1e-9 * max(want[s], 1)
        assert abs(sum(r["taken"] for r in g) - want[s]) <= max(own) / 2 + 1e-6
        assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in g)
        if want[s] < 2 * sizes[s] * (1 - 1e-9):
            rates = brute.entropy_rates(own, want[s], mix.CAP, mix.BINS)
            assert all(abs(r["rate"] - rates[r["size"]]) < 1e-9 for r in g if r["size"])


def test_mix_on_odd_rows_and_reruns(odd, odd_rows, none):
    once = sorted(map(str, mix.mix_sources(odd).collect()))
    assert len(once) == len(odd_rows)
    assert once == sorted(map(str, mix.mix_sources(odd.repartition(5)).collect()))
    assert mix.mix_sources(none).count() == 0
    many = mix.mixed_documents(odd)
    assert many.columns == odd.columns


def test_targets_share_out_the_excess(spark):
    sizes = {f"s{i}": n for i, n in enumerate([5, 1000, 10, 70, 0, 300, 2])} | {None: 40}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mix.source_targets(table).collect()}
    want = brute.targets(sizes, mix.WEIGHTS, mix.SHARE, mix.CAP)
    assert all(abs(got[s] - want[s]) < 1e-9 * max(want[s], 1) for s in sizes)
    assert abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 1e-6
