"""Scalar column functions: token estimates, identifiers, citations, links, breadcrumbs and normalisers.

Everything is a Catalyst expression. The texts of citations, links, ids and breadcrumbs are fixed values. Years and clocks are arguments, never read from the machine.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Limits of chunking and embedding.
MAX_CHUNK, OVERLAP_SHARE, SOFT_LIMIT, HARD_LIMIT = 1500, 0.15, 1500, 8192
#: Section numbers of federal regulations.
SECTION = r"(?i)^\d+\.\d+[a-z0-9\-\.]*$"


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: code points above U+FFFF count twice."""
    return F.octet_length(F.encode(text, "UTF-16BE")) / 2


def tokens(text: Column) -> Column:
    """Estimated tokens: ceil(ceil(length / 4) * 1.1) in doubles; 0 for null or empty texts."""
    return F.coalesce(F.ceil(F.ceil(utf16_length(text) / 4) * F.lit(1.1)), F.lit(0)).cast("long")


def strip(text: Column) -> Column:
    """Without white space at either end; trim() alone takes spaces only."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def chunk_count(n: Column, target: int = MAX_CHUNK) -> Column:
    return F.ceil(n / target).cast("long")


def slug(name: Column) -> Column:
    """Lower case with runs of white space as one dash."""
    return F.regexp_replace(F.lower(name), r"\s+", "-")


def city_key(name: Column) -> Column:
    """Lower case, white space as dashes, other signs dropped."""
    return F.regexp_replace(slug(name), "[^a-z0-9-]", "")


def uri(text: Column) -> Column:
    """Percent-encoding as for a URI component: spaces as %20, and !'()* as they are."""
    out = F.url_encode(text)
    for a, b in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def is_section(section: Column) -> Column:
    return section.rlike(SECTION)


def federal_citation(title: Column, section: Column, subsection: Column | None = None) -> Column:
    """`21 C.F.R. § 117.5(a)`; null where the section number is not valid."""
    tail = F.coalesce(subsection, F.lit("")) if subsection is not None else F.lit("")
    return F.when(is_section(section), F.concat(title.cast("string"), F.lit(" C.F.R. § "), section, tail))


def federal_url(title: Column, part: Column, section: Column) -> Column:
    return F.concat(F.lit("https://www.ecfr.gov/current/title-"), title.cast("string"), F.lit("/part-"), part.cast("string"), F.lit("/section-"), section)


def section_part(section: Column) -> Column:
    return F.when(is_section(section), F.substring_index(section, ".", 1).cast("int"))


def federal_breadcrumb(title: Column, chapter: Column, part: Column, section: Column) -> Column:
    c = lambda a, x: F.concat(F.lit(a), x.cast("string"))
    return F.array(c("Title ", title), c("Chapter ", chapter), c("Part ", part), c("Section ", section))


def state_breadcrumb(family: str, name: Column, chapter: Column, section: Column) -> Column:
    """family: statute, tac, county or municipal."""
    head = {"statute": "Texas Statutes", "tac": "Texas Admin Code", "county": "Texas Counties", "municipal": "Texas Municipalities"}[family]
    own = F.concat(name, F.lit(" County")) if family == "county" else name
    return F.array(F.lit(head), own, F.concat(F.lit("Chapter "), chapter), F.concat(F.lit("Section "), section))


def chunk_id(family: str, *parts: Column) -> Column:
    """cfr-21-117-117.5-0, tx-statute-HS-..., tx-tac-..., county-fort-bend-..., municipal-fort_worth-..."""
    if family == "county":
        parts = slug(parts[0]), *parts[1:]
    return F.concat_ws("-", F.lit(family), *(p.cast("string") for p in parts))


def source_id(family: str, key: Column) -> Column:
    head = {"cfr": "cfr-title"}.get(family, family)
    return F.concat_ws("-", F.lit(head), slug(key) if family == "county" else key.cast("string"))


def statute_citation(code_name: Column, section: Column, year: int) -> Column:
    """code_name: the code's abbreviation from the registry; null for unknown codes."""
    return F.concat(F.lit("Tex. "), code_name, F.lit(" Ann. § "), section, F.lit(f" (West {year})"))


def rule_citation(title: Column, section: Column, year: int) -> Column:
    return F.concat(title.cast("string"), F.lit(" Tex. Admin. Code § "), section, F.lit(f" ({year})"))


def county_citation(county: Column, code_name: Column, section: Column, year: int) -> Column:
    return F.concat(county, F.lit(" County, Tex., "), code_name, F.lit(" sect. "), section, F.lit(f" ({year})"))


def city_citation(city: Column, section: Column, year: int) -> Column:
    return F.concat(city, F.lit(", Tex., Code of Ordinances sect. "), section, F.lit(f" ({year})"))


def order_citation(county: Column, number: Column, adopted: Column) -> Column:
    return F.concat(county, F.lit(" County Commissioners Court Order No. "), number, F.lit(" ("), F.date_format(adopted, "MMM. d, yyyy"), F.lit(")"))


def statute_url(code: Column, section: Column) -> Column:
    return F.concat(F.lit("https://statutes.capitol.texas.gov/Docs/"), code, F.lit("/htm/"), code, F.lit("."), section, F.lit(".htm"))


def rule_url(title: Column, chapter: Column, section: Column) -> Column:
    t = title.cast("string")
    return F.concat(
        F.lit("https://texreg.sos.state.tx.us/public/readtac$ext.TacPage?sl=R&app=9&p_dir=&p_rloc="), t,
        F.lit("&p_tloc=&p_ploc=&pg=1&p_tac=&ti="), t, F.lit("&pt=&ch="), chapter, F.lit("&rl="), section,
    )


def ordinance_url(family: str, platform: Column, base: Column, section: Column) -> Column:
    """Link to a section on its platform; the base link without a section, null without a base link."""
    at = {"county": "/codes/overview?nodeId=", "municipal": "#"}[family]
    sep = F.when(platform == "municode", "?nodeId=").when(platform == "amlegal", at).otherwise("#")
    return F.when(F.coalesce(section, F.lit("")) == "", base).otherwise(F.concat(base, sep, uri(section)))


def summary(text: Column, most: int = 500) -> Column:
    """First block of a text, cut to 500 characters."""
    first = F.split(text, "\n\n").getItem(0)
    return F.when(F.length(first) > most, F.concat(F.substring(first, 1, most), F.lit("..."))).otherwise(first)


def excerpt(text: Column, most: int = 200) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def content_type(key: Column) -> Column:
    """Media type by suffix (fixed values)."""
    out = None
    for suffix, kind in ((".xml", "application/xml"), (".json", "application/json"), (".txt", "text/plain"), (".html", "text/html")):
        out = F.when(key.endswith(suffix), kind) if out is None else out.when(key.endswith(suffix), kind)
    return out.otherwise("application/octet-stream")


def storage_prefix(jurisdiction: Column) -> Column:
    rest = F.substring(jurisdiction, 4, 1 << 20)
    return (
        F.when(jurisdiction == "US", "federal/").when(jurisdiction == "TX", "texas/")
        .when(jurisdiction.startswith("TX-48"), F.concat(F.lit("counties/"), rest, F.lit("/")))
        .when(jurisdiction.startswith("TX-"), F.concat(F.lit("municipal/"), rest, F.lit("/")))
    )


def source_type(jurisdiction: Column) -> Column:
    return (
        F.when(jurisdiction == "US", "federal").when(jurisdiction == "TX", "state")
        .when(jurisdiction.rlike(r"^TX-\d{5}$"), "county").when(jurisdiction.rlike("^TX-[a-z_]+$"), "municipal").otherwise("unknown")
    )


def age_hours(then: Column, now: Column) -> Column:
    return F.round((F.unix_millis(now) - F.unix_millis(then)) / 3_600_000, 1)


def is_fresh(then: Column, now: Column, days: float = 7) -> Column:
    return (F.unix_millis(now) - F.unix_millis(then)) < days * 86_400_000


def clean_html_text(text: Column) -> Column:
    """Site lines dropped, blanks and blank lines collapsed. Trimming comes before collapsing."""
    text = strip(F.regexp_replace(text, r"(?im)(\[Home\]|Copyright|Statutes Home).*$", ""))
    return F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n")


def clean_markdown(text: Column) -> Column:
    text = F.regexp_replace(text, "\r\n", "\n")
    return strip(F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def percentage(part: Column, whole: Column, digits: int) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, digits)).otherwise(F.lit(0.0))


def natural_key(text: Column) -> Column:
    """A key whose order is that of the text with its numbers taken as numbers: "12.9" before "12.10" before "12.10b".

    Runs of digits become their length and digits without leading zeros, other runs end in a sign below all others; numbers come before
    other signs, and of equal keys ("1", "01") none is first. As a column it is sorted by ranges, without a window over all rows. Null stays null.
    """
    runs = F.regexp_extract_all(text, F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))

    def part(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+(?=[0-9])", "")
        return F.when(run.rlike("^[0-9]"), F.concat(F.lit("0"), F.lpad(F.length(digits).cast("string"), 6, "0"), digits)).otherwise(F.concat(F.lit("1"), run, F.lit("\x01")))

    return F.array_join(F.transform(runs, part), "")
