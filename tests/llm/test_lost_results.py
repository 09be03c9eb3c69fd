"""Cases in which results were once lost."""

import random

import pytest

from pyspark.sql import functions as F

from ledgerlake.llm import html_text, jaccard, licenses, quality, secrets_scan

SCHEMA = "doc_id bigint, text string, n int, root int, score double, lang string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 0.5, "en") for i, t in rows], SCHEMA)


PARAGRAPH = ("The committee met on Tuesday to discuss the harbour works, and after two hours of debate it agreed to a plan "
             "that the town had waited for since the storm of last winter.")


@pytest.mark.parametrize("page", [
    '<div class="content no-sidebar">{}</div>', '<div id="content" class="has-sidebar">{}</div>', '<div class="post hentry comments-open">{}</div>',
    '<div class="entry-content share-enabled">{}</div>', '<section class="article with-banner">{}</section>',
    '<article><section class="has-notice">{}</section></article>'])
def test_names_of_the_layout_drop_no_article(page):
    body = f"<p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>"
    html = f'<html><body><nav><a href="/">Home</a></nav>{page.format(body)}<div class="sidebar"><p>{PARAGRAPH}</p></div></body></html>'
    assert html_text.main_text(html) == f"{PARAGRAPH} {PARAGRAPH}"


def test_near_copies_under_null_keys_link(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (8, text + " more"), (9, "quite another text of seven words"), (None, " ".join(f"v{i}" for i in range(40))), (None, " ".join(f"v{i}" for i in range(41)))]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(docs(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 56, 8), (8, 57, 8), (9, 2, 9), (None, 36, None), (None, 37, None)], key=repr)
    kept = [(r.doc_id, r.text) for r in jaccard.keep_one(docs(spark, rows)).collect()]
    assert len(kept) == 3 and (8, text + " more") in kept and rows[2] in kept


def test_one_row_of_each_group_stays_whatever_the_keys(spark):
    copy, clean = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(50))
    rows = [(2, copy), (9, copy + " x"), (9, clean), (5, "same row of some seven words here"), (5, "same row of some seven words here"), (7, ""), (7, None), (7, None)]
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(docs(spark, rows)).collect()), key=repr)
    assert kept == sorted([(2, copy), (9, clean), rows[3], (7, ""), (7, None), (7, None)], key=repr)


def random_string(dice, n, letters="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"):
    return "".join(dice.choice(letters) for _ in range(n))


def test_random_parts_beside_base_spans_are_found(spark):
    dice = random.Random(4)
    names = ["configuration", "international", "responsibility", "documentation", "administrator", "certification", "experimental", "preferences"]
    train = [(i, f'api_key="{random_string(dice, 40)}" ' + " ".join(dice.choice(names) + "-" + dice.choice(names) for _ in range(30))) for i in range(60)]
    tail, left, right = random_string(dice, 40), random_string(dice, 20, "ghijkGHIJKLMNOPQRSTUVWXYZ0123456789"), random_string(dice, 20, "ghijkGHIJKLMNOPQRSTUVWXYZ0123456789")
    hard = [(100, f"key AKIA{random_string(dice, 16, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')}/{tail} end"), (101, f"{left}{'0123456789abcdef01'}{right}"),
            (102, "my_administrator_password: abcdefgh12345678 and documentation-preferences-administrator"), (103, "")]
    found = {r.doc_id: r for r in secrets_scan.scan(docs(spark, train + hard)).collect()}
    text = dict(hard)
    parts = {i: [(s["kind"], text[i][s["start"]:s["end"]]) for s in found[i]["spans"]] for i in text}
    assert parts[100] == [(1, text[100][4:24]), (3, f"/{tail}")]
    assert [k for k, _ in parts[101]] == [3, 2, 3] and "".join(x for _, x in parts[101]) == text[101]
    assert [k for k, _ in parts[102]] == [0]
    clean = {r.doc_id: r.text for r in secrets_scan.redact(docs(spark, hard + train)).collect()}
    assert tail not in clean[100] and left not in clean[101] and right not in clean[101] and clean[103] == ""


def test_a_notice_is_found_in_lines_of_any_length(spark):
    notice = licenses.TEMPLATES["bsd"][0].split()
    spread = " ".join(f"{w} filler{i % 3} f{i} g" for i, w in enumerate(notice[:25]) for _ in [0]).split()
    rows = []
    for size in (130, 256, 257, 400, 3000):
        for at in range(0, size - len(spread), max(1, (size - len(spread)) // 7)):
            line = [f"x{i}" for i in range(size)]
            line[at:at + len(spread)] = spread
            rows.append((len(rows), " ".join(line)))
    got = {r.labels for r in licenses.scan(docs(spark, rows)).collect()}
    assert got == {"bsd"}


def test_few_labels_fit(spark):
    dice = random.Random(5)
    good = lambda: " ".join(dice.choice(["the", "river", "town", "council", "winter", "garden", "letter", "people"]) for _ in range(80)) + "."        # noqa: E731
    poor = lambda: " ".join(dice.choice(["$$$", "CLICK", "##", "win!!!", "FREE", "|||", "000", ">>"]) for _ in range(80))     # noqa: E731
    rows = [(i, good() if i % 2 else poor()) for i in range(60)]
    for marked in (18, 2):
        labels = spark.createDataFrame([(i, i % 2, 0) for i in range(marked)], "doc_id bigint, quality int, toxic int")
        kept = {r.doc_id for r in quality.score(docs(spark, rows + rows[:2] * 20), labels).where("keep").collect()}
        assert {i for i in range(1, 60, 2)} <= kept
        if marked == 18:
            assert not kept & set(range(0, 60, 2))


def test_quality_pseudo_labels_come_from_all_unlabelled_rows(spark):
    """The surest rows of each view, against a plain choice from all scores."""
    docs_, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs_, labels)
    marks = quality.labelled(labels)
    read = ["text", "lang", "source", "n_chars"]
    pool = quality._prepared(docs_.unionByName(docs_.limit(30)), "doc_id", "text").withColumn("row", F.xxhash64(*read))     # repeated rows count once
    known = {r.key for r in marks.collect()}
    rows = {r.key: r.row for r in pool.select("key", "row").collect() if r.key not in known}
    shown = {r.doc_id: (r.content_score, r.metadata_score) for r in quality.score(docs_, labels, model=model).collect()}
    order = {r.row: r.h for r in pool.select("row", F.xxhash64("row").alias("h")).collect()}
    taken = [set(list(rows.values())[:5]), set()]
    got = quality.surest(pool, marks, model, taken, 7)
    for mine, other in ((0, 1), (1, 0)):
        for good in (1, 0):
            p = {rows[k]: (s[mine] if good else 1 - s[mine]) for k, s in shown.items() if k in rows}
            want = sorted((x for x in p if p[x] >= quality.SURE and x not in taken[other]), key=lambda x: (-round(p[x], 3), order[x], x))[:7]
            assert [row for v, g, row in got if (v, g) == (other, good)] == want
    assert any(got) and len(rows) > 50
