"""Toxicity, personal data, line dedup, secrets, near-duplicates and mixing against plain versions and awkward rows."""

import hashlib
import math
import re

import numpy as np
import pytest
from brute import AWKWARD_SCHEMA, LONG, awkward_documents, near_components, shingle_set, without_repeats, words
from pyspark.sql import functions as F

from gleanery.llm import line_dedup, minhash, mixing, personal_data, secret_scan, toxicity

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_documents(), AWKWARD_SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], AWKWARD_SCHEMA)


# --- toxicity


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    chain = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    rows = toxicity.scored(docs, chain).select("doc.doc_id", toxicity.is_toxic(F.col("scores")).alias("p"))
    counts = {(r.toxic, r.p): r["count"] for r in rows.join(labels.filter("doc_id % 2 = 1"), "doc_id").groupBy("toxic", "p").count().collect()}
    assert counts.get((1, True), 0) >= 0.9 * (counts.get((1, True), 0) + counts.get((1, False), 0))
    assert counts.get((0, False), 0) >= 0.995 * (counts.get((0, False), 0) + counts.get((0, True), 0))


def test_later_models_see_earlier_probabilities():
    rng = np.random.default_rng(1)
    bad = rng.integers(0, 2, 400)
    columns = np.flatnonzero(np.ones(400)) % 7 + 1
    rows = np.concatenate([np.arange(400), np.flatnonzero(bad)])
    columns = np.concatenate([columns, np.zeros(bad.sum(), dtype=int)])
    use = np.ones((2, toxicity.FOLDS + 1, 8), dtype=bool)
    use[1, :, 0] = False  # the second category may not use the telling feature itself
    models = toxicity.fit_chain(rows, columns, np.full(400, 3), np.column_stack([bad, bad]).astype(float), np.arange(400) % 3, use)
    assert models[0].features[0] > 2 and models[1].features[0] == 0
    assert models[1].chain[1] > 2  # but learns from the first one's out-of-fold probability


def test_toxicity_awkward_rows(spark, awkward, empty, tmp_path):
    labels = spark.createDataFrame([(1, 1, 1), (6, 1, 0), (None, 0, 1), (8, None, None), (999, 0, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(awkward.select("doc_id", "text"), labels)
    assert toxicity.scored(awkward, chain).count() == awkward.count()
    none = toxicity.train(awkward.select("doc_id", "text"), labels.limit(0))
    assert toxicity.scored(awkward, none).filter("scores.toxic >= 0.5").count() == 0
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = toxicity.rejecting(spark, awkward, str(tmp_path))
    assert kept.columns == awkward.columns
    assert toxicity.rejecting(spark, empty, str(tmp_path)).count() == 0


# --- personal data


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f and x.y@z and @a.b and a@b..c a@b.c.d-e",
    "..a@b.co, %+-@q.r; é a@b.c",
    "1.2.3.4.5 256.1.1.1 001.002.003.004 1.2.3 9.9.9.9.9.9.9.9 00000255.0.0.0",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 and 41111111111111111111 4 1 1 1 1111 1111 11 11",
    "+1 (456) 555-2186 +49.30.123456 +1 2 +123456789012345678 ++1 (2 +1-(((((((",
    "😀 card 4111111111111111 😀 mail x@y.zz",
    "write to IBAN DE89 3704 0044 0532 0130 00 bank, not DE89 3704 0044 0532 0130 01",
    "call (456) 555-2186 now; 456-555-2186",
    "a" * 50_000 + "@" + "b." * 20_000 + "c " + "1." * 30_000,
    "1 " * 20_000,
]


def test_personal_data_against_the_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), DOCS)
    rows = {r.doc_id: r for r in personal_data.digest(docs).collect()}
    for i, text in enumerate(TEXTS):
        wanted = base_spans(text)
        row = rows[i]
        assert row.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest(), i
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(x.startswith(k) for x in wanted) for k in PATTERNS]
        assert row.spans.split(",")[: len(wanted)] == (wanted or [row.spans.split(",")[0]][: len(wanted)])
    assert rows[8].n_iban == 1 and "iban:14:41" in rows[8].spans
    assert rows[9].n_local_phone == 1  # the second has no telephone word nearby


def test_ibans_beside_other_words(spark):
    texts = {
        "ES91 2100 0418 4502 0005 1332 EUR": ["ES91 2100 0418 4502 0005 1332"],
        "BE68 5390 0754 7034 BIC and AT611904300234573201 ABCD EUR": ["BE68 5390 0754 7034", "AT611904300234573201"],
        "PL61 1090 1014 0000 0712 1981 2874 ES91 2100 0418 4502 0005 1332 EUR": ["PL61 1090 1014 0000 0712 1981 2874", "ES91 2100 0418 4502 0005 1332"],
        "😀 IBAN DE89 3704 0044 0532 0130 00, ES91 2100 0418 4502 0005 1333 EUR": ["DE89 3704 0044 0532 0130 00"],
        "ZZ33 2100 0418 4502 0005 1332 USD": ["ZZ33 2100 0418 4502 0005 1332"],  # no listed country: the longest beginning that passes
    }
    check = 98 - int("21000418450200051332" + "3535" + "00") % 97
    texts = {k.replace("ZZ33", f"ZZ{check:02d}"): [x.replace("ZZ33", f"ZZ{check:02d}") for x in v] for k, v in texts.items()}
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    rows = {r.doc_id: r.spans for r in personal_data.digest(docs).collect()}
    for i, (text, wanted) in enumerate(texts.items()):
        spans = [x.split(":") for x in rows[i].split(",") if x.startswith("iban")]
        assert [text[int(a) : int(b)] for _, a, b in spans] == wanted, text


def test_masking(spark, awkward):
    docs = spark.createDataFrame([(1, "mail x@y.zz or call +49 30 1234567!", 1)], "doc_id long, text string, pii int")
    assert personal_data.masked(docs).first().text == "mail <email> or call <phone>!"
    assert personal_data.masked(docs).columns == docs.columns
    assert personal_data.masked(awkward).count() == awkward.count()
    assert personal_data.digest(awkward.limit(0)).count() == 0


# --- line dedup


def line(name, count):
    return " ".join(f"{name}{i}" for i in range(count))


def test_line_dedup_against_brute_force(spark):
    a, b, c, d, e = line("a", 60), line("b", 20), line("c", 20), line("d", 15), line("e", 10)
    texts = [
        (1, "\n".join([b, c, d, a])),
        (2, "\n".join([e, b, c, d, e])),  # a run of three short lines
        (3, "\n".join([e, a, "", e, a])),  # one long line, twice
        (4, "\n".join([b, c])),  # too short a run
        (5, "\n".join([a, e, e])),
        (6, "\n".join([a, e])),  # extended to the right by a short line
        (7, "\n".join([d, c, b])),  # other order
        (8, "\n".join([e, c, d, a, e])),  # extended to the left
        (9, "\n".join([b, "", c, d])),  # blank lines do not part a run
    ]
    rows = {r.doc_id: r.text for r in line_dedup.digest(spark.createDataFrame(texts, DOCS)).collect()}
    wanted = dict(zip([i for i, _ in texts], without_repeats(texts), strict=True))
    assert {k: [x for x in v.split("\n") if x] for k, v in rows.items()} == {k: [x for x in v.split("\n") if x] for k, v in wanted.items()}


def test_line_dedup_awkward_rows(awkward, empty):
    rows = line_dedup.digest(awkward).collect()
    texts = [(r.doc_id, r.text) for r in rows]
    assert len(rows) == awkward.count()
    assert texts.count((6, "other words here\nand an end")) == 2  # identical rows are one document
    assert (2, None) in texts and (3, "") in texts and (4, " \n\t\n ") in texts and (5, LONG) in texts
    assert (1, "first line\nlast line") in texts  # the row without doc_id comes first
    kept = line_dedup.deduplicated(awkward)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert line_dedup.digest(empty).count() == 0


# --- secrets


def test_secrets_on_held_out_findings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labelled = secret_scan.ruled(secret_scan.candidates(docs)).filter("label is not null").select("doc_id", "begin", "label")
    rows = secret_scan.scan(docs, labelled.filter("xxhash64(doc_id) % 2 = 0"))
    judged = rows.drop("label").join(labelled.filter("xxhash64(doc_id) % 2 != 0"), ["doc_id", "begin"])
    counts = {(r.label, r.secret): r["count"] for r in judged.groupBy("label", "secret").count().collect()}
    assert sum(n for (label, secret), n in counts.items() if bool(label) == secret) >= 0.95 * sum(counts.values())
    assert sum(n for (label, _), n in counts.items() if label == 1) > 0


def test_secret_positions_and_awkward_rows(spark, awkward, empty):
    docs = spark.createDataFrame([(1, '😀 token = "0641917ea4e9feb9cda83477b57ac2654884f485"', "s")], "doc_id long, text string, source string")
    row = secret_scan.candidates(docs).first()
    assert (row.begin, row.end, row.value) == (11, 51, "0641917ea4e9feb9cda83477b57ac2654884f485")
    assert secret_scan.digest(awkward).count() == 0
    assert secret_scan.digest(empty).count() == 0


def test_words_around_a_secret_with_a_long_name(spark):
    texts = ['AWS_SECRET_ACCESS_KEY="wJalrXUtnFEMI0K7MDENGbPxRfiCYzzzzzzzzKEY1"', "DATABASE_PASSWORD: abcd0123efgh4567ijkl"]
    docs = spark.createDataFrame([(i, x, "s") for i, x in enumerate(texts)], "doc_id long, text string, source string")
    found = secret_scan.candidates(docs)
    before = {(r.doc_id, r.value): (r.before, r.after) for r in found.collect()}
    assert before[0, "wJalrXUtnFEMI0K7MDENGbPxRfiCYzzzzzzzzKEY1"] == ('AWS_SECRET_ACCESS_KEY="', '"')
    assert before[1, "abcd0123efgh4567ijkl"] == ("DATABASE_PASSWORD: ", "")
    assert before[1, "DATABASE_PASSWORD"] == ("", ": abcd0123efgh4567ijkl")
    named = secret_scan.described(found, docs).filter("value like 'wJ%' or value like 'abcd%'")
    assert [(r.f_named, r.label) for r in secret_scan.ruled(named).collect()] == [(1.0, 1)] * 2


def test_values_of_a_secrets_name(spark):
    cases = {
        "password=Tr0ub4dor3x": {"Tr0ub4dor3x"},
        '😀 pwd = "s3cr3t!Long.pass$word99" x': {"s3cr3t!Long.pass$word99"},
        "config['passwd'] = 'two words 1'": {"two words 1"},
        "login (pwd: hunter22), then": {"hunter22),", "hunter22"},
        "?token=hunter22&user=bob": {"hunter22&user=bob", "hunter22"},
        "auth: token=abc123x": {"token=abc123x", "abc123x"},
        "auth: user=bob;token=abc123x": {"user=bob;token=abc123x", "user=bob", "abc123x"},
        r'{\"password\": \"hunter22\"}': {"hunter22"},
        "password: keyboard:cat99": {"keyboard:cat99"},
        "password=short and the password of it": set(),
        "key=" * 20_000 + " " + "key" * 20_000 + ' key="' + "\\" * 50_000: None,  # neither recursion nor a long search
    }
    docs = spark.createDataFrame([(i, x, "s") for i, x in enumerate(cases)], "doc_id long, text string, source string")
    rows = secret_scan.candidates(docs).collect()
    for i, (text, wanted) in enumerate(cases.items()):
        own = [r for r in rows if r.doc_id == i]
        assert all(text[r.begin : r.end] == r.value for r in own)
        if wanted is not None:
            assert sorted(r.value for r in own) == sorted(wanted), text


# --- near-duplicates


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    wanted, sizes = near_components(texts, 2)
    for r in minhash.digest(docs, width=2).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], wanted[r.doc_id], wanted[r.doc_id] == r.doc_id)


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = [f"t{i}" for i in range(101)]
    texts = {}
    for i in range(40):  # copies with their own changes: many pairs lie around the threshold
        own = list(base)
        for j in range(i % 9):
            own[(7 * i + 11 * j) % 101] = f"x{i}y{j}"
        texts[i] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    wanted, _ = near_components(texts, 2)
    assert {r.doc_id: r.component_id for r in minhash.digest(docs, width=2).collect()} == wanted
    nodes = spark.createDataFrame([(1, i, i == 0) for i in texts], "band long, node long, main boolean")
    sets = minhash.full_sets(docs, nodes, 2)
    links = minhash.components(minhash.block_links(nodes, sets, 80))
    found = {r.node: r.component for r in links.collect()}
    assert {k: found.get(k, k) for k in texts} == wanted


def test_signature_estimates_similarity():
    hashes = minhash.WordHashes()
    one = minhash.shingles(" ".join(f"a{i}" for i in range(1001)), 2, hashes)
    other = minhash.shingles(" ".join(f"a{i}" for i in range(200, 1201)), 2, hashes)
    same = (minhash.signature(one, 2000) == minhash.signature(other, 2000)).mean()
    assert abs(same - 800 / 1200) < 0.05


def test_minhash_all_texts_of_one_id_count(spark):
    one, other = (" ".join(f"{letter}{i}" for i in range(100)) for letter in "ab")
    rows = [(1, one), (1, other), (5, one + " end"), (6, other + " end"), (7, "alone in the world")]
    for docs in (spark.createDataFrame(rows, DOCS), spark.createDataFrame(rows[::-1], DOCS).repartition(3)):
        assert {r.doc_id: r.component_id for r in minhash.digest(docs, width=2).collect()} == {1: 1, 5: 1, 6: 1, 7: 7}


def test_minhash_copies_without_id_go(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "first"), (None, text, "copy"), (None, text.upper(), "copy"), (None, "no other has this text at all", "own"), (None, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print string")
    left = minhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r["print"] for r in left.collect()) == ["empty", "first", "own"]


def test_near_duplicates_awkward_rows(awkward, empty):
    rows = minhash.digest(awkward, width=2).collect()
    assert len(rows) == awkward.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert by[6][0] == by[6][1]
    assert {x[1] for x in by[7]} == {7}  # one id, two texts: one document
    assert by[8] == [(1, 8, True)] and by[9] == [(1, 8, False)]
    assert by[5][0][0] == len(shingle_set(LONG, 2))
    kept = minhash.one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.filter("doc_id = 9").count() == 0 and kept.filter("doc_id is null").count() == 2
    assert minhash.digest(empty).count() == 0


# --- mixing


def plan_of(sizes):
    """Targets by the definition: shares by weight, capped at three times, the rest shared again."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + [k for k in sizes if k is None]
    weights = {k: i % 3 + 1 for i, k in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[k] for k in capped)
        shares = sum(weights[k] for k in names if k not in capped)
        goal = {k: 3 * sizes[k] if k in capped else rest * weights[k] / shares for k in names}
        above = {k for k in names if goal[k] > 3 * sizes[k]}
        if not above:
            return goal
        capped |= above


def test_mixing_against_brute_force(spark):
    sources = ["b", "é", "a", None, "c", "Z", "tiny", "\U0001f600", "￮"]
    rows = [(i, "w " * (1 + i % 23), sources[i % 9 if i % 9 != 6 or i < 30 else 0]) for i in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.digest(docs).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    goal = plan_of(sizes)
    source_of = {i: s for i, _, s in rows}
    taken = {}
    for r in found:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and math.isclose(r.target, goal[source], rel_tol=1e-12)
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size
        taken[source] = taken.get(source, 0) + r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.15 * goal[s] + 60 for s in sizes)
    again = mixing.digest(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    emitted = {(r.doc_id, r["count"]) for r in mixing.mix(docs).groupBy("doc_id").count().collect()}
    assert emitted == {(r.doc_id, r.taken // r.size) for r in found if r.taken}


def test_mixing_awkward_rows(spark, awkward, empty):
    rows = mixing.digest(awkward).collect()
    assert len(rows) == awkward.count()
    assert sum(r.size for r in rows if r.doc_id == 5) == 120_000
    assert all(r.size == 0 and r.taken == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert mixing.mix(awkward).columns == awkward.columns
    assert mixing.digest(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.digest(blank).collect()] == [(0.0, 0)] * 2
