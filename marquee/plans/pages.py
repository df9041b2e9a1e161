"""Extraction from stored pages: the `pages` table, and pages composed from the catalogue views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup
from ..operators import pages as page_ops
from .registry import query
from .views import ITEMS, REVIEWS, items, raw_titles, reviews, table, with_views, words

UNESCAPED = (
    "replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"
)


def tag_free_sql(value: str) -> str:
    return UNESCAPED.format(f"regexp_replace({value}, '<[^>]*>', '', 'g')")


@query(
    "extract_title",
    f"""select page_id, nullif({tag_free_sql("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")}, '') as title,
      nullif({tag_free_sql("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")}, '') as head from pages""",
)
def extract_title(spark, folder):
    html = F.col("html")
    return table(spark, folder, "pages").select(
        "page_id", markup.text_of(html, "h1").alias("title"), markup.text_of(html, "title").alias("head")
    )


@query(
    "extract_attr",
    """select page_id, nullif(regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1), '') as lang,
      nullif(regexp_extract(html, '<a[^>]* href="([^"]*)"', 1), '') as first_link,
      nullif(regexp_extract(html, '<div[^>]* data-key="([^"]*)"', 1), '') as next_key from pages""",
)
def extract_attr(spark, folder):
    html = F.col("html")
    return table(spark, folder, "pages").select(
        "page_id",
        markup.attribute_of(html, "html", "lang").alias("lang"),
        markup.attribute_of(html, "a", "href").alias("first_link"),
        markup.attribute_of(html, "div", "data-key").alias("next_key"),
    )


LINKS = f"""links as (select page_id, cast(i - 1 as int) as pos, hrefs[i] as href, {tag_free_sql('texts[i]')} as text from (
  select page_id, hrefs, texts, unnest(range(1, len(hrefs) + 1)) as i from (
    select page_id, regexp_extract_all(html, '(?s)<a\\b[^>]*\\bhref="([^"]*)"[^>]*>(.*?)</a>', 1) as hrefs,
      regexp_extract_all(html, '(?s)<a\\b[^>]*\\bhref="([^"]*)"[^>]*>(.*?)</a>', 2) as texts from pages)))"""


@query("extract_links", with_views("select page_id, pos, href, text from links", LINKS))
def extract_links(spark, folder):
    links = markup.links_of(F.col("html"))
    found = table(spark, folder, "pages").select("page_id", F.posexplode(links).alias("pos", "link"))
    return found.select("page_id", "pos", "link.href", "link.text")


def _list(name: str, values, tag: str = "li"):
    """`<li data-testid=name><ul><li>..</li>..</ul></li>`, nothing at all for a NULL list."""
    entries = F.array_join(F.transform(values, lambda v: F.concat(F.lit(f"<{tag}>"), v, F.lit(f"</{tag}>"))), "")
    return F.coalesce(words(f'<li data-testid="{name}"><span>x</span><ul>', entries, "</ul></li>"), F.lit(""))


def _spread(rows, key: str):
    """The test tables are single files, which Spark reads in one task; reading pages should use all cores.

    The narrow rows are moved, not the pages composed from them.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, key)


def title_pages(spark, folder):
    """A title page per item, laid out like the real ones."""
    raw = _spread(raw_titles(spark, folder), "id")
    details, box = F.col("details"), F.col("boxoffice")

    def escaped(value):
        return F.replace(value, F.lit("&"), F.lit("&amp;"))

    def optional(before, value, after):
        return F.coalesce(words(before, value, after), F.lit(""))

    scores = [F.col(f"review_summary.{n}") for n in page_ops.SCORE_NAMES]
    actors = F.transform(
        F.map_entries("actors"),
        lambda e: words('<a data-testid="title-cast-item__actor" href="', e["value"], "/?ref_=tt_cl_t_", e["key"], '">who</a>'),
    )
    others = F.transform(
        F.map_entries("imdb_recommendations"),
        lambda e: words('<a class="x ipc-poster-card__title--y" href="', e["value"], "?ref_=tt_sims_t_", e["key"], '">t</a>'),
    )
    return raw.select(
        "id",
        words(
            '<!DOCTYPE html><html><body><!-- <h1 data-testid="hero-title-block__title">no</h1> -->',
            '<h1 class="a" data-testid="hero-title-block__title">', escaped(F.concat("original_title", F.lit(" & co"))),
            '</h1><div data-testid="hero-media__poster"><div><img class="p" src="', F.col("poster_url"), '"><br></div></div>',
            optional('<div data-testid="hero-rating-bar__aggregate-rating"><b>IMDb RATING</b><span>',
                     F.concat(F.col("agg_rating.avg_rating"), F.lit("</span><i>"), F.col("agg_rating.num_votes")), "</i></div>"),
            *[words('<span class="score">', s, "</span>") for s in scores],
            F.array_join(actors, ""), F.array_join(others, "\n"),
            '<div data-testid="genres">', F.array_join(F.transform("genres", lambda g: words("<a>", g, "</a>")), " "), "</div><ul>",
            _list("title-details-releasedate", F.array_compact(details["release_date"])),
            _list("title-details-origin", details["countries_of_origin"]),
            _list("title-details-languages", F.array_compact(details["language"])),
            _list("title-details-akas", details["also_known_as"]),
            _list("title-details-companies", details["production_companies"]),
            _list("title-details-filminglocations", details["filming_locations"]),
            optional('<li data-testid="title-techspec_runtime"><button>Runtime</button><div>', details["runtime"], "</div></li>"),
            *[
                optional(f'<li data-testid="{name}"><ul><li><span>', box[field], "</span></li></ul></li>")
                for name, field in [
                    ("title-boxoffice-budget", "budget"),
                    ("title-boxoffice-grossdomestic", "boxoffice_gross_domestic"),
                    ("title-boxoffice-openingweekenddomestic", "boxoffice_gross_opening"),
                    ("title-boxoffice-cumulativeworldwidegross", "boxoffice_gross_worldwide"),
                ]
            ],
            "</ul></body></html>",
        ).alias("html"),
    )


LISTED = 25  # items of a listing page


def listing_pages(spark, folder):
    """Listing pages of some items each, with other links around them. The first item of a page stands on the next one again."""
    rows = raw_titles(spark, folder).select("id", "genres", "actors")
    page = F.floor(F.col("id") / LISTED)
    on = rows.withColumn("again", F.explode(F.array(F.lit(False), F.lit(True)))).where(~F.col("again") | (F.col("id") % LISTED == 0))
    genres = F.array_join(F.when(F.col("again"), F.reverse("genres")).otherwise(F.col("genres")), ", ")
    link = F.when(F.col("id") % 2 == 0, words('<a class="x" href="/title/tt', F.col("id"), '/">')).otherwise(
        words("<a href='/title/tt", F.col("id"), "/' >")
    )
    genre = F.when(F.col("id") % 11 != 0, words('<span class="runtime">90 min</span><span class="genre">\n', genres, " </span>"))
    item = words(
        '<div class="lister-item"><a href="/poster/">p</a><div class="lister-item-content"><h3><span>1.</span>', link,
        "Name</a></h3><div><p>", F.coalesce(genre, F.lit("")), '</p></div><p><a href="/name/nm1/">Somebody</a></p></div></div>',
    )
    rows = on.select((page + F.col("again").cast("int")).alias("page_id"), F.struct(~F.col("again"), "id", item.alias("item")).alias("i"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("i")), lambda i: i["item"]), "\n")
    around = words('<html><body><nav><a href="/nav">Menu</a><span class="genre">All</span></nav>', F.col("listed"), "</body></html>")
    return rows.groupBy("page_id").agg(listed.alias("listed")).select("page_id", around.alias("html"))


@query(
    "extract_listing",
    with_views(
        """select '/title/tt' || id || '/' as id, case when id % 11 <> 0 then coalesce(case when id % 25 = 0 then main_genre else genre_1 end, '') end
          as main_genre from (select id, genre_1, split_part(main_genre, ' ', 1) as main_genre from items)""",
        ITEMS,
    ),
)
def extract_listing(spark, folder):
    return page_ops.listing(listing_pages(spark, folder))


def review_list_pages(spark, folder):
    """The pages under which reviews of a title are listed: not all have a header or a further page."""
    key = F.col("id")
    header = F.when(key % 5 != 0, words('<div class="lister header"><p>x</p><div>\n<span>', F.format_number(key * 37, 0), " Reviews</span> </div></div>"))
    more = F.when(key % 3 == 0, words("<div class='load-more-data' data-key='k&amp;", key, "'>")).when(
        key % 3 == 1, words('<p class="load-more-data x" data-ajax="/a" data-key="g', key, '">')
    )
    html = words(
        '<html><body><div data-key="other"></div>', F.coalesce(header, F.lit('<div class="header">none</div>')),
        '<div class="load-more-data">no key</div>', F.coalesce(more, F.lit("")), "</body></html>",
    )
    return items(spark, folder).select("id", html.alias("html"))


@query(
    "extract_review_lists",
    with_views(
        """select id, case when id % 5 <> 0 then cast(id * 37 as int) else 0 end as reviews_num,
          case id % 3 when 0 then 'k&' || id when 1 then 'g' || id end as next_key from items""",
        ITEMS,
    ),
)
def extract_review_lists(spark, folder):
    return page_ops.review_lists(review_list_pages(spark, folder))


@query(
    "extract_scores",
    with_views(
        """select id, user_review_num || '.2K' as user_review_num, cast(critic_review_num as varchar) as critic_review_num,
          case when id % 3 = 0 then 'n/a' else cast(id % 100 as varchar) end as metascore from items
        where user_review_num is not null""",
        ITEMS,
    ),
)
def extract_scores(spark, folder):
    texts = markup.texts_of(F.col("html"), "span", "class", "score")
    found = title_pages(spark, folder).select("id", markup.scores(texts, page_ops.SCORE_NAMES).alias("s"))
    return found.select("id", "s.*").where(F.col("user_review_num").isNotNull())


@query(
    "extract_rating_text",
    with_views(
        """select id, case when id % 13 <> 0 and num_votes is not null then (cast(runtime as int) % 10) || '.5/10' end as avg_rating,
          case when id % 13 <> 0 and num_votes is not null then num_votes || '.5K' end as num_votes from items""",
        ITEMS,
    ),
)
def extract_rating_text(spark, folder):
    rating = markup.text_of(F.col("html"), "div", "data-testid", "hero-rating-bar__aggregate-rating")
    found = title_pages(spark, folder).select("id", markup.rating_parts(rating).alias("r"))
    return found.select("id", "r.avg_rating", "r.num_votes")


@query(
    "extract_ranked_links",
    with_views(
        """select id, 'actors' as kind, 1 as rank, actor_1 || '/' as link from items
        union all select id, 'actors', 2, actor_2 || '/' from items
        union all select id, 'actors', 3, actor_3 || '/' from items where actor_3 is not null
        union all select id, 'similar', k, '/title/tt' || (id + k * 11) || '/' from items, (select cast(unnest([1, 2, 3, 4]) as int) as k)""",
        ITEMS,
    ),
)
def extract_ranked_links(spark, folder):
    found = page_ops.title_records(title_pages(spark, folder))
    parts = [
        found.select("id", F.lit(kind).alias("kind"), F.explode(column).alias("rank_text", "link"))
        for kind, column in [("actors", "actors"), ("similar", "imdb_recommendations")]
    ]
    return parts[0].unionByName(parts[1]).select("id", "kind", F.col("rank_text").cast("int").alias("rank"), "link")


@query(
    "extract_details",
    with_views(
        """select id, original_title || ' & co' as original_title, poster_url,
          genre_1 || '|' || genre_2 || '|' || coalesce(genre_3 || '|', '') || main_genre as genres,
          case when release_date is null then '' else case id % 3 when 0 then strftime(release_date, '%B %Y') || ' (Italy)'
            when 1 then strftime(release_date, '%B %-d, %Y') || ' (Peru)' else strftime(release_date, '%Y') end || '|' end || '1 May 1999' as release_date,
          country_of_origin_1 || case when id % 2 = 1 then '|Italy|Peru|Chile' else '' end as countries,
          coalesce(original_language || '|', '') || 'it' as languages, 'Il ' || original_title || '|x' as also_known_as,
          case when id % 7 <> 0 then production_company_1 || '|SAFFI' end as companies,
          'Old Mill, ' || original_title || ', ' || country_of_origin_1 || '|y' as locations,
          (cast(runtime as int) % 3 + 1) || ' hours ' || (cast(runtime as int) % 60) || ' minutes' as runtime,
          '$' || (id * 1000) || ' (estimated)' as budget, cast(null as varchar) as boxoffice_gross_domestic,
          '$' || id as boxoffice_gross_opening, boxoffice_gross_worldwide from items""",
        ITEMS,
    ),
)
def extract_details(spark, folder):
    found = page_ops.title_records(title_pages(spark, folder))

    def listed(column, name):
        return F.array_join(column, "|").alias(name)

    return found.select(
        "id",
        "original_title",
        "poster_url",
        listed("genres", "genres"),
        listed("details.release_date", "release_date"),
        listed("details.countries_of_origin", "countries"),
        listed("details.language", "languages"),
        listed("details.also_known_as", "also_known_as"),
        listed("details.production_companies", "companies"),
        listed("details.filming_locations", "locations"),
        "details.runtime",
        "boxoffice.*",
    )


def review_pages(spark, folder):
    """A review page per line item with two review blocks, one of them without a rating."""
    raw = _spread(reviews(spark, folder), "order_id").withColumn(
        "written", F.date_format("review_date", "d MMMM yyyy")
    )
    link = F.concat(F.lit('<a href="'), F.col("author"), F.lit('">who</a>'))
    body = F.concat(F.col("title"), F.lit("said &lt;b&gt; &amp; left"))

    def block(rating):
        return words(
            '<div class="lister review-container"><div><span class="a"></span>', rating,
            '<span class="display-name-link">', link, '</span><span class="review-date">', F.col("written"),
            '</span></div><a class="title" href="/r/">', F.col("title"), '</a><div class="text show-more__control">',
            body, '</div><div class="actions text-muted">', F.col("helpfulness"), "<br></div></div>",
        )

    rated = words("<span>", F.col("rating"), "</span>")
    html = words("<html><body><span>1</span>", block(rated), "<p>", block(F.lit("")), "</body></html>")
    # An order has at most seven lines.
    key = F.col("order_id") * 8 + F.col("line")
    return raw.select(key.alias("id"), html.alias("html"))


@query(
    "extract_reviews",
    with_views(
        """select order_id * 8 + line as id, position, case when position = 0 then rating end as rating,
          strftime(review_date, '%-d %B %Y') as date, title, title || 'said <b> & left' as text, author, helpfulness
        from reviews, (select cast(unnest([0, 1]) as int) as position)""",
        REVIEWS,
    ),
)
def extract_reviews(spark, folder):
    return page_ops.review_records(review_pages(spark, folder))
