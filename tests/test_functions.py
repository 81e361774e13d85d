from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftwell.functions import contact, dates, money, text, urls

X = F.col("x")


@pytest.mark.parametrize(
    "raw, core",
    [
        ("Lead Data Engineer (Hybrid)", "lead data engineer"),
        ("Data Engineer (m/w/d)", "data engineer"),
        ("Ingénieur Data h/f", "ing nieur data"),
        ("Lead Data Engineer - Remote, EMEA", "lead data engineer emea"),
        ("Spark Developer | Contract | B2B", "spark developer"),
        ("C++ / Node.js Engineer", "c++ node.js engineer"),
        ("Fully remote tester", "fully tester"),
        ("Contractors wanted", "contractors wanted"),
        ("full--time writer", "full time writer"),
        ("éf/d analyst", "analyst"),
        ("", ""),
    ],
)
def test_normalise_title(one, raw, core):
    assert one(text.normalise_title(X), raw) == core
    assert one(text.normalise_title(X), core) == one(text.normalise_title(text.normalise_title(X)), core)


def test_full_time_with_one_blank_is_noise_but_not_across_two(one):
    assert one(text.normalise_title(X), "full time writer") == "writer"


@pytest.mark.parametrize(
    "raw, core", [("Orbit GmbH", "orbit"), ("Orbit Ltd.", "orbit"), ("Orbit B.V.", "orbit"), ("Saga Group", "saga group"), ("S.A. Sol", "sol")]
)
def test_normalise_company(one, raw, core):
    assert one(text.normalise_company(X), raw) == core


def test_strip_html_keeps_escaped_markup_as_text(one):
    assert one(text.strip_html(X), "<p>One &amp; two</p><ul><li>a</li><li>b</li></ul>") == "One & two\na\nb"
    assert one(text.strip_html(X), "&lt;p&gt;x&lt;/p&gt;") == "<p>x</p>"
    assert one(text.strip_html(X), "&amp;lt;b&gt;") == "<b>"
    assert one(text.strip_html(X), "a<br/><br><br>\n b ") == "a\n\nb"


def test_truncate_marks_the_cut(one):
    assert one(text.truncate(X, 3), "abcd") == "abc\n[truncated]"
    assert one(text.truncate(X, 4), "abcd") == "abcd"


def test_pick_string_skips_blank_but_does_not_trim(one):
    assert one(text.pick_string(F.lit(None).cast("string"), F.lit("  "), F.lit(" a "))) == " a "
    assert one(text.pick_string(F.lit(""))) == ""


@pytest.mark.parametrize("raw, company, title", [("Orbit: Data: Lead", "Orbit", "Data: Lead"), ("No colon", "", "No colon")])
def test_split_at_first_colon(one, raw, company, title):
    assert one(text.before_first_colon(X), raw) == company
    assert one(text.after_first_colon(X), raw) == title


@pytest.mark.parametrize(
    "raw, iso",
    [
        ("2024-05-01", "2024-05-01T00:00:00.000Z"),
        ("2024-05-01T10:00:00+02:00", "2024-05-01T08:00:00.000Z"),
        ("2024-05-01T10:00:00.250Z", "2024-05-01T10:00:00.250Z"),
        ("1714521600", "2024-05-01T00:00:00.000Z"),
        ("1714521600000", "2024-05-01T00:00:00.000Z"),
        ("2026", "1970-01-01T00:33:46.000Z"),
        ("0", "1970-01-01T00:00:00.000Z"),
        ("Wed, 01 May 2024 10:00:00 GMT", "2024-05-01T10:00:00.000Z"),
        ("1 May 2024 10:00 EST", "2024-05-01T15:00:00.000Z"),
        ("three days ago", ""),
        ("12:30:00", ""),
        ("2024-13-77", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_dates(one, raw, iso):
    assert one(dates.to_iso_date(dates.text_to_timestamp(X)), raw) == iso


def test_age_and_strict_bounds(one):
    now = F.lit(datetime(2024, 5, 11))
    assert one(dates.age_in_days(F.lit("2024-05-01").cast("date"), now)) == 10
    assert one(dates.older_than(F.lit(datetime(2024, 5, 1)), now, 10)) is False
    assert one(dates.older_than(F.lit(datetime(2024, 4, 30, 23, 59)), now, 10)) is True
    assert one(dates.older_than(F.lit(None).cast("timestamp"), now, 10)) is False
    assert one(dates.younger_than(F.lit(datetime(2024, 5, 1)), now, 10)) is False


@pytest.mark.parametrize(
    "raw, key",
    [
        ("https://Shop.example.com/Jobs/1?x=1#y", "shop.example.com/jobs/1"),
        ("https://shop.example.com/jobs/1/", "shop.example.com/jobs/1"),
        ("https://shop.example.com/jobs/1//", "shop.example.com/jobs/1/"),
        ("https://shop.example.com:443/a/../b/./c", "shop.example.com/b/c"),
        ("http://shop.example.com:8080", "shop.example.com:8080"),
        ("https://shop.example.com", "shop.example.com"),
        ("mailto:a@b.example.com", "a@b.example.com"),
        ("Not A Url", "not a url"),
        ("", ""),
        (None, ""),
    ],
)
def test_canonical_url(one, raw, key):
    assert one(urls.canonical_url(X), raw) == key


@pytest.mark.parametrize(
    "href, link",
    [
        ("/a b", "https://h.example.com/a%20b"),
        ("é", "https://h.example.com/d/%C3%A9"),
        ("../x", "https://h.example.com/x"),
        ("?q=1", "https://h.example.com/d/p?q=1"),
        ("//k.example.com/y", "https://k.example.com/y"),
        ("HTTPS://K.example.com", "https://k.example.com/"),
    ],
)
def test_resolve(one, href, link):
    base = urls.url_parts(F.lit("https://h.example.com/d/p?z=9"))
    assert one(urls.url_text(urls.url_parts(urls.resolve(X, base))), href) == link


def test_vendor_and_form_urls(one):
    assert one(urls.ats_from_url(X), "https://jobs.eu.lever.co/orbit/1") == "lever"
    assert one(urls.ats_from_url(X), "https://orbit.example.com/?a=1&gh_jid=5") == "greenhouse"
    assert one(urls.ats_from_url(X), "https://notlever.co.example.com/") is None
    lever = urls.apply_url_for(F.lit("lever"), X)
    once = one(lever, "https://jobs.lever.co/orbit/1?src=x")
    assert once == "https://jobs.lever.co/orbit/1/apply"
    assert one(lever, once) == once
    hinted = urls.apply_url_for(F.lit("greenhouse"), X, F.lit("orbit"))
    assert one(hinted, "https://orbit.example.com/?gh_jid=5") == "https://job-boards.greenhouse.io/embed/job_app?for=orbit&token=5"


@pytest.mark.parametrize(
    "raw, email",
    [
        ("Send your CV to jobs@orbit.example.com", "jobs@orbit.example.com"),
        ("Questions: privacy@orbit.example.com apply", None),
        ("The office, hello@orbit.example.com, is nice", None),
        ("x@a.example.com " + "-" * 300 + " apply: x@a.example.com", "x@a.example.com"),
        ("résuméx a@b.example.com", "a@b.example.com"),
        ("résumé a@b.example.com", None),
        ("no address", None),
    ],
)
def test_apply_email(one, raw, email):
    assert one(contact.extract_apply_email(X), raw) == email


def test_pick_option(one):
    options = F.array(*[F.lit(o) for o in ("Yes", "No", "Not now", "Maybe later")])
    pick = text.pick_option(options, X)
    assert [one(pick, w) for w in (" yes", "not", "later", "maybe later please", "zzz", " ")] == [
        "Yes", "Not now", "Maybe later", "Maybe later", None, None,
    ]


def test_money(one):
    assert one(money.estimate_cost(F.lit(2_000_000), F.lit(1_000_000), 0.15, 0.6)) == pytest.approx(0.9)
    assert one(money.ratio(F.lit(1), F.lit(0))) == 0
    assert one(money.per_thousand(F.lit(0.5), F.lit(0))) == 0


@pytest.mark.parametrize(
    "base, href, want",
    [
        ("https://a.example.com/open/Careers", "../jobs/job-1/", "https://a.example.com/jobs/job-1/"),
        ("https://a.example.com/x/y/z", "../v1.2/b", "https://a.example.com/x/v1.2/b"),
        ("https://a.example.com/", "../b", "https://a.example.com/b"),
        ("https://a.example.com/x/", "../", "https://a.example.com/"),
        ("https://a.example.com:8080/x/y", "../b", "https://a.example.com:8080/b"),
    ],
)
def test_one_folder_up_is_resolved_at_once(one, base, href, want):
    """The text needs no walk over its dot segments any more."""
    assert one(urls.resolve(F.lit(href), urls.url_parts(F.lit(base)))) == want


@pytest.mark.parametrize(
    "url",
    [
        "https://a.example.com", "https://a.example.com/", "https://a.example.com/x//y/", "https://A.example.com/X", "http://a.example.com/x?q=1#f",
        "https://a.example.com:443/x", "https://a.example.com:8/x", "https://a.example.com/x/../y", "https://a.example.com/.well", "https://a.example.com/x y",
        "https://a.example.com/x\n", "HTTPS://a.example.com/x", "mailto:a@b", "no url", "", None, "https://a.example.com/x?", "https://a.example.com/?q",
    ],
)
def test_settled_urls_are_keyed_as_parsed_ones(one, url):
    from siftwell.operators.pages import page_key

    parsed = F.coalesce(F.regexp_replace(urls.url_text(urls._messy_parts(F.col("x"))), r"/+\z", ""), F.lit("none"))
    assert one(page_key(F.col("x"), "none"), url) == one(parsed, url)
    assert one(urls.url_text(urls.url_parts(F.col("x"))), url) == one(urls.url_text(urls._messy_parts(F.col("x"))), url)
