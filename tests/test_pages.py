"""Page rules on hand-written and malformed pages."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from marquee.functions import markup
from marquee.operators import pages as page_ops

TITLE = """<!DOCTYPE html><html><body><script>var x = "<h1 data-testid='hero-title-block__title'>no</h1>";</script>
<h1 data-testid='hero-title-block__title' class=big>Red <i>&amp; Blue</i></h1>
<div data-testid="hero-media__poster"><a title="a > b"><img alt=x src="http://p.jpg"><img src="second.jpg"></a></div>
<div data-testid="hero-rating-bar__aggregate-rating"><div>IMDb RATING</div><span>9.0</span>/10<p>2.6M</p></div>
<span class="score">1.2K</span><span class="score">76</span>
<a data-testid="title-cast-item__actor" href="/name/nm1/?ref_=tt_cl_t_1">A</a>
<a data-testid="title-cast-item__actor">no link</a>
<a data-testid="title-cast-item__actor" href="/name/nm2/?ref_=tt_cl_t_2">B</a>
<a class="ipc-poster-card__title ipc-poster-card__title--x" href="/title/tt9/?ref_=tt_sims_tt_t_1">Z</a>
<div data-testid="genres"><a>Action</a><a>Comedy</a></div>
<li data-testid="title-details-origin"><ul><li>Italy</li><li>Peru</li></ul></li>
<li data-testid="title-details-languages"><span>none</span></li>
<li data-testid="title-techspec_runtime"><div>1 hour <b>11</b> minutes</div></li>
<li data-testid="title-boxoffice-budget"><ul><li>$1 (estimated)</li><li>$2</li></ul></li>
<p>unclosed <b>"""

REVIEWS = """<div class="header"><div>2 Reviews</div></div>
<div class="lister-item review-container"><span><svg></svg></span><span>8</span>
 <a class="title" href="#"> Fine
</a><span class="display-name-link"><a href="/user/ur1/?ref_=x">me</a></span><span class="review-date">14 August 2016</span>
 <div class="text show-more__control">Long<br>text</div><div class="actions text-muted">
 171 out of 185 found this helpful.
</div></div>
<div class="review-container"><span class="display-name-link"></span><span class="review-date">1 May 2001</span></div>"""


def frame(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "id long, html string")


def test_title_record(spark):
    row, empty, nothing = page_ops.title_records(frame(spark, TITLE, "<p>hello", None)).orderBy("id").collect()
    assert row["original_title"] == "Red & Blue"
    assert row["poster_url"] == "http://p.jpg"
    assert row["agg_rating"].asDict() == {"avg_rating": "9.0/10", "num_votes": "2.6M"}
    # Scores go by position: with one missing, the last name stays empty.
    assert tuple(row["review_summary"]) == ("1.2K", "76", None)
    assert row["actors"] == {"1": "/name/nm1/", "2": "/name/nm2/"}
    assert row["imdb_recommendations"] == {"1": "/title/tt9/"}
    assert row["genres"] == ["Action", "Comedy"]
    assert row["details"]["countries_of_origin"] == ["Italy", "Peru"]
    assert row["details"]["language"] == []
    assert row["details"]["release_date"] is None
    assert row["details"]["runtime"] == "1 hour 11 minutes"
    assert row["boxoffice"]["budget"] == "$1 (estimated)"
    for blank in (empty, nothing):
        assert blank["original_title"] is None and blank["genres"] is None and blank["agg_rating"] is None
        assert blank["actors"] == {}


def test_only_ten_actors_and_the_last_of_a_rank(spark):
    links = "".join(
        f'<a data-testid="title-cast-item__actor" href="/name/nm{i}/?ref_=tt_cl_t_{min(i, 9)}">x</a>' for i in range(1, 15)
    )
    row = page_ops.title_records(frame(spark, links)).first()
    assert len(row["actors"]) == 9 and row["actors"]["9"] == "/name/nm10/"


def test_review_records(spark):
    rows = page_ops.review_records(frame(spark, REVIEWS, "")).orderBy("position").collect()
    assert len(rows) == 2
    first, second = rows
    assert (first["rating"], first["date"], first["title"]) == (8, "14 August 2016", " Fine\n")
    assert (first["author"], first["text"]) == ("/user/ur1/?ref_=x", "Longtext")
    assert "171 out of 185" in first["helpfulness"]
    assert (second["rating"], second["author"], second["text"]) == (None, None, None)


ITEM = """<div class="lister-item mode"><a href="/img/">poster</a><div class='a lister-item-content'><h3><span>1.</span>
<a href='{id}'>Name</a> <a href="/other/">b</a></h3><p><span class="runtime">99 min</span>{genre}</p><a href="/name/nm9/">Who</a></div></div>"""


def listed(*items):
    inside = "".join(ITEM.format(id=i, genre="" if g is None else f'<span class="genre">{g}</span>') for i, g in items)
    return f'<a href="/nav">Menu</a><span class="genre">All</span><div>{inside}</div><a href="/title/no/">x</a>'


def test_listing_takes_items_alone_and_the_last_of_an_id(spark):
    page = listed(("/title/a/", "\nAction, Drama "), ("/title/b/", "Crime"), ("/title/d/", None), ("/title/b/", "Sci-Fi &amp; x"))
    later = listed(("/title/a/", "Comedy")) + '<div class="lister-item-content"><b>no link</b><span class="genre">War</span></div>'
    rows = page_ops.listing(frame(spark, page, later, None, "<p>").withColumnRenamed("id", "page_id")).collect()
    assert {tuple(r) for r in rows} == {("/title/a/", "Comedy"), ("/title/b/", "Sci-Fi"), ("/title/d/", None)}


def test_items_within_items():
    reader = page_ops.PageReader(page_ops.LISTING_RULES, page_ops.LISTING_SCOPE)
    inner = '<div class="lister-item-content"><a href="2">x</a><span class="genre">Two</span></div>'
    found = reader.read(f'<div class="lister-item-content"><p>{inner}<a href="1">x</a><span class="genre">One</span></p></div><a href="3">')
    assert found == [{"link": ["2"], "genres": ["Two"]}, {"link": ["2"], "genres": ["Two"]}]


def test_review_lists(spark):
    pages = [
        '<div class="x header"><p>7</p><div>\n<b>1,234 Reviews</b></div><div>9 Reviews</div></div><span class="load-more-data q" data-key="k&amp;1">',
        '<div class="header">5 Reviews</div><div class="header"><div>6 Reviews</div></div><div class="load-more-data"></div><div data-key="no">',
        "<div class='load-more-data'></div><p data-key='two' class='load-more-data'><div class='header'><div>none</div></div>",
        None,
    ]
    rows = page_ops.review_lists(frame(spark, *pages)).orderBy("id").collect()
    assert [(r["reviews_num"], r["next_key"]) for r in rows] == [(1234, "k&1"), (0, None), (0, "two"), (0, None)]


def test_both_kinds_of_quotes(spark):
    html = F.col("html")
    double = '<a id="i" href="/one?x=1">One</a><div data-key="k" class="score">7</div><a href="/two">Two &amp; <b>3</b></a>'
    columns = [
        markup.attribute_of(html, "div", "data-key").alias("key"),
        markup.attributes_of(html, "a", "href").alias("hrefs"),
        markup.links_of(html).alias("links"),
        markup.text_of(html, "div", "class", "score").alias("score"),
        markup.texts_of(html, "div", "class", "score").alias("scores"),
    ]
    one, two = frame(spark, double, double.replace('"', "'")).select("id", *columns).orderBy("id").drop("id").collect()
    assert one == two and one["hrefs"] == ["/one?x=1", "/two"] and one["links"][1]["text"] == "Two & 3" and one["key"] == "k"


def test_workers_need_no_copy_of_the_package(tmp_path):
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    stored = tmp_path / "reader"
    stored.write_bytes(cloudpickle.dumps(page_ops.PageReader(page_ops.TITLE_RULES)))
    script = f"import pickle; print(pickle.load(open({str(stored)!r}, 'rb')).read('<span class=score>7</span>'))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd="/", env=env, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "[{'scores': ['7']}]", done.stderr


def test_tags_that_pages_repeat_are_understood_once(monkeypatch):
    parsed = []
    attributes = page_ops._attributes
    monkeypatch.setattr(page_ops, "_attributes", lambda written: parsed.append(written) or attributes(written))
    reader = page_ops.PageReader(page_ops.REVIEW_RULES, page_ops.REVIEW_SCOPE)
    first = reader.read(REVIEWS)
    times = len(parsed)
    assert [reader.read(REVIEWS) for _ in range(5)] == [first] * 5 and len(parsed) == times
    monkeypatch.setattr(page_ops, "MOST_TAGS", 2)
    assert page_ops.PageReader(page_ops.REVIEW_RULES, page_ops.REVIEW_SCOPE).read(REVIEWS) == first


def test_steps_that_pages_repeat_are_worked_out_once(monkeypatch):
    worked_out = []
    step = page_ops.PageReader._step
    monkeypatch.setattr(page_ops.PageReader, "_step", lambda *a: worked_out.append(1) or step(*a))
    reader = page_ops.PageReader(page_ops.REVIEW_RULES, page_ops.REVIEW_SCOPE)
    first = reader.read(REVIEWS)
    times = len(worked_out)
    assert len(first) == 2 and times
    # Other authors, texts and entities, but the same tags at the same places.
    other = REVIEWS.replace("ur1", "ur2").replace("Long", "a &lt; b ").replace(" Fine", "Bad")
    found = [reader.read(other) for _ in range(3)]
    assert len(worked_out) == times and found == [found[0]] * 3
    assert found[0][0] == first[0] | {"author": ["/user/ur2/?ref_=x"], "text": ["a < b text"], "title": ["Bad\n"]}
    monkeypatch.setattr(page_ops, "MOST_STEPS", 3)
    assert page_ops.PageReader(page_ops.REVIEW_RULES, page_ops.REVIEW_SCOPE).read(REVIEWS) == first


def test_tags_are_the_same_by_turns_and_by_pattern():
    block = '<div class="review-container"><a class="title"{0}>T{1}</a><span>1</span><span>8</span>{2}</div>'
    reader = page_ops.PageReader(page_ops.REVIEW_RULES, page_ops.REVIEW_SCOPE)
    plain = reader.read(block.format("", "", ""))
    assert plain == [{"title": ["T"], "spans": ["1", "8"]}]
    # A > in a value, a comment and a script with tags, an end that is missing: only a pattern tells them apart.
    assert reader.read(block.format(' id="a > b"', "", "")) == plain
    assert reader.read(block.format("", "<!-- <b> -->", "<script>var x = '<span>9</span>'</script>")) == plain
    assert reader.read(block.format("", "<!--x-->", "") + "<p") == plain
    assert reader.read(block.format("", " > 1 < 2", "")) == [{"title": ["T > 1 < 2"], "spans": ["1", "8"]}]
    assert reader.read(block.format("", "", "<span>x>b<3</span>"))[0]["spans"] == ["1", "8", "x>b<3"]


def test_many_pages_are_read_as_one_by_one(spark, monkeypatch):
    rng = random.Random(4)
    pieces = [
        '<div class="review-container">', "<div>", "</div>", "</div>", "<p>", "<br>", "</p>", "<span>", '<span class="review-date">', "</span>", "</a>",
        '<a class="title" href="/r/">', '<span class="display-name-link">', "<a href='/user/ur1/'>", "<a>", '<div class="text show-more__control">',
        '<div class="actions text-muted">', "text", "8", "a &lt; b", "&am", "p;", "\n", "é",
    ]
    pages = ["".join(rng.choices(pieces, k=rng.choice([0, 5, 40]))) for _ in range(400)]
    odd = [None, "", "text", pages[5] + "<!-- <p> -->", pages[7] + "<script>a < b</script>", '<div class="review-container" id="a > b"><span>1</span>', "<p"]
    for i, page in enumerate(odd):
        pages.insert(50 * i, page)
    for rules, scope in ((page_ops.REVIEW_RULES, page_ops.REVIEW_SCOPE), (page_ops.TITLE_RULES + page_ops.REVIEW_RULES[1:3], None)):
        names = [rule.name for rule in rules]
        reader = page_ops.PageReader(rules, scope)
        expected = {(i, at): [r.get(n) for n in names] for i, p in enumerate(pages) for at, r in enumerate(reader.read(p or ""))}
        read, *_ = page_ops.read_many(page_ops.PageReader(rules, scope), names, pa.array(pages))
        # All but NULL, those on which signs do not stand by turns, and the few longest.
        assert len(pages) - 5 - page_ops.FEW_PAGES < read.sum() <= len(pages) - 5
        for name, value in (("BYTES_AT_ONCE", 1 << 24), ("BYTES_AT_ONCE", 3_000), ("MOST_STEPS", 20), ("MOST_CELLS", 1 << 12)):
            with monkeypatch.context() as patch:
                patch.setattr(page_ops, name, value)
                rows = page_ops.extract_pages(frame(spark, *pages), rules, scope).collect()
            assert {(r["id"], r["position"]): [r[n] for n in names] for r in rows} == expected and len(rows) == len(expected)
