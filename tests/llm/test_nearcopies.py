"""The grouped prefix join against a comparison of all sets."""

import random
import re

import pytest

from jobsignals.llm.nearcopies import NearCopies, one_of_each, op5_grouped_prefix_join


def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posts = {}
    for i, s in enumerate(sets):
        for x in s:
            posts.setdefault(x, []).append(i)
    seen = set()
    for members in posts.values():
        for i in members:
            for j in members:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    common = len(sets[i] & sets[j])
                    if 100 * common >= 80 * len(sets[i] | sets[j]):
                        parent[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def found(join):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join.documents().collect()), key=str)


def sample(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows, texts = [], []
    common = " ".join(rng.choices(words, k=40))
    for i in range(n):
        if texts and rng.random() < 0.6:
            base = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(base))
                base[at : at + rng.randint(0, 2)] = [rng.choice(words)]
            text = " ".join(base)
        else:
            text = " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 4, 5, 6, 20, 60, 200])))
            if rng.random() < 0.3:
                text += " " + common
        texts.append(text)
        rows.append((i, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,list_rows", [(1, 20_000), (2, 7)])
def test_equals_all_comparisons(documents, seed, list_rows):
    rows = sample(seed, 160)
    assert found(NearCopies(documents(rows).repartition(4), list_rows=list_rows, broadcast_ids=10)) == by_force(rows)


def test_odd_rows(documents):
    long_text = " ".join(f"w{i % 70_001}" for i in range(300_000))
    rows = [(1, None), (2, ""), (3, " \t\x0b"), (5, "One two"), (4, "one\x0ctwo"), (6, "one two three"),
            (7, "a b c d e"), (7, "a b c d e"), (7, "other words under the same id"), (None, "A B C D E"),
            (None, "z"), (8, long_text), (9, long_text + " end"), (10, "x" * 3_000_000), (0, "X" * 3_000_000),
            (11, "été à É"), (12, "été à é")]
    assert found(NearCopies(documents(rows))) == by_force(rows)
    kept = one_of_each(documents(rows + rows[7:8]))
    assert kept.columns == documents(rows).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 6, 7, 7, None, 8, 0, 11, 12], key=str)
    assert found(NearCopies(documents([]))) == []


def test_query_equals_all_comparisons(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in op5_grouped_prefix_join(spark, sf_dir).collect()), key=str)
    assert got == by_force(rows)


@pytest.mark.parametrize("list_rows", [20_000, 9])
def test_all_links_of_a_dense_group(documents, list_rows):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(50):
        words = list(base)
        words[rng.randrange(120)] = f"own{i}"
        rows.append((i, " ".join(words)))
    rows += [(100, rows[0][1]), (101, rows[0][1])] + [(200 + d, t) for d, t in sample(4, 40)]
    least = {}
    for doc, text in sorted(rows):
        if shingles(text):
            least.setdefault(frozenset(shingles(text)), doc)
    want = {tuple(sorted((a, b))) for x, a in least.items() for y, b in least.items()
            if a != b and 100 * len(x & y) >= 80 * len(x | y)}
    assert len(want) > 50 * 4
    join = NearCopies(documents(rows).repartition(3), list_rows=list_rows)
    got = [(min(r.a_id, r.b_id), max(r.a_id, r.b_id)) for r in join.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert found(join) == by_force(rows)


class Counted(NearCopies):
    """Counts the pairs whose sets are compared."""

    compared = 0

    def verified(self, pairs):
        self.compared += pairs.count()
        return super().verified(pairs)


def test_components_of_a_dense_group_compare_few_pairs(documents):
    """pairs of groups come first, and a group of n near copies costs some n pairs."""
    rng = random.Random(5)
    rows = []
    for i in range(150):
        words = [f"w{k}" for k in range(120)]
        words[rng.randrange(120)] = f"own{i}"
        rows.append((i, " ".join(words)))
    rows += [(200 + d, t) for d, t in sample(6, 60)]
    join = Counted(documents(rows).repartition(3))
    assert found(join) == by_force(rows)
    assert join.compared < 10 * len(rows)  # all pairs of the group are 11,175


def test_groups_of_several_classes_come_before_their_classes(documents):
    """A pair of groups is met once, by bits that all classes of a group share."""
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(6)]
    rows += [(10 + i, " ".join([f"start{i}", *base[: 60 + 10 * i]])) for i in range(5)]
    join = NearCopies(documents(rows))
    members = join.members().collect()
    several = {r.grp for r in members if r.known is not None}
    of_group = {}
    for r in join.groups.collect():
        of_group.setdefault(r.grp, []).append(r)
    assert several and several == {g for g, classes in of_group.items() if len(classes) > 1}
    for r in members:
        if r.known is not None:
            bits = [int.from_bytes(c.bits) & int.from_bytes(r.known) for c in of_group[r.grp]]
            assert len(set(bits)) == 1 and r.node == min(c.node for c in of_group[r.grp])
    assert found(join) == by_force(rows)
    sets = {i: shingles(t) for i, t in rows}
    want = {(a, b) for a, x in sets.items() for b, y in sets.items()
            if a < b and 100 * len(x & y) >= 80 * len(x | y)}
    assert {(min(r.a_id, r.b_id), max(r.a_id, r.b_id)) for r in join.pairs().collect()} == want


def test_chains_of_versions_stay_whole(documents):
    """Only neighbours link: pairs that would connect fail, and all that are left are compared."""
    rng = random.Random(7)
    common, rows = [f"c{i}" for i in range(90)], []
    for i in range(40):
        rows.append((i, " ".join(common + [f"v{k}" for k in range(4 * i, 4 * i + 20)])))
    rows += [(100 + i, " ".join(common + [f"x{rng.randrange(10 ** 6)}" for _ in range(9)])) for i in range(40)]
    assert found(NearCopies(documents(rows).repartition(3))) == by_force(rows)
