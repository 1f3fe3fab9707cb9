"""URL and path expressions: resolve, normalise, and derive archive paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioworks.functions.text import col_, last_segment, pad2, split_n, strip_token

# URL shapes.
URL_PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)"
HAS_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
MALFORMED = "/blog/NaN/NaN/NaN/"


@dataclass(frozen=True)
class Site:
    """The site being archived."""

    base_url: str = "http://site.example"
    section: str = "/blog/"
    index_base: str = "/archive"

    @property
    def host(self) -> str:
        return self.base_url.split("://", 1)[1].removeprefix("www.")

    @property
    def dated_pattern(self) -> str:
        return self.section + r"(\d{4})/(\d{1,2})/(\d{1,2})/([\w-]+)\.html"

    @property
    def link_pattern(self) -> str:
        """An internal link: any scheme, with or without ``www.``, or root-relative."""
        host = self.host.replace(".", r"\.")
        return r"(?:(?:https?:)?//(?:www\.)?" + host + r")?" + self.section


def url_host(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(col_(c), URL_PARTS, 2))


def url_path(c: Column | str) -> Column:
    return F.regexp_extract(col_(c), URL_PARTS, 3)


def _drop_dot_segments(path: Column) -> Column:
    def step(acc: Column, seg: Column) -> Column:
        up = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1)))
        return F.when(seg == ".", acc).when(seg == "..", up).otherwise(F.concat(acc, F.array(seg)))

    # A closing dot segment leaves a directory, so it keeps its slash.
    closed = F.regexp_replace(path, r"/\.$", "/")
    closed = F.when(closed.rlike(r"/\.\.$"), F.concat(closed, F.lit("/"))).otherwise(closed)
    parts = F.aggregate(F.split(closed, "/"), F.array().cast("array<string>"), step)
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.array_join(parts, "/")).otherwise(path)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """The absolute form of ``href`` found on the page ``base``."""
    b, h = col_(base), col_(href)
    scheme = F.regexp_extract(b, URL_PARTS, 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(b, URL_PARTS, 2))
    folder = F.regexp_replace(F.when(url_path(b) == "", F.lit("/")).otherwise(url_path(b)), r"[^/]*$", "")
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_tail = F.substring(h, F.length(h_path) + 1, F.length(h))
    return (
        F.when(h == "", b)
        .when(h.rlike(HAS_SCHEME), h)
        .when(F.startswith(h, F.lit("//")), F.concat(scheme, F.lit(":"), h))
        .when(F.startswith(h, F.lit("/")), F.concat(root, _drop_dot_segments(h_path), h_tail))
        .when(F.startswith(h, F.lit("#")), F.concat(F.substring_index(b, "#", 1), h))
        .when(F.startswith(h, F.lit("?")), F.concat(F.regexp_extract(b, r"^([^?#]*)", 1), h))
        .otherwise(F.concat(root, _drop_dot_segments(F.concat(folder, h_path)), h_tail))
    )


def url_fragment(c: Column | str) -> Column:
    """``#fragment`` with its sign, ``""`` when absent."""
    return F.regexp_extract(col_(c), r"(#.*)$", 1)


def normalise_url(c: Column | str, site: Site) -> Column:
    """One spelling per page of the site: its scheme, no ``www.``, absolute, no fragment."""
    bare = F.regexp_replace(col_(c), r"#.*$", "")
    host = site.host.replace(".", r"\.")
    own = F.regexp_replace(bare, r"(?i)^(?:https?:)?//(?:www\.)?" + host + r"(?=[/?]|$)", site.base_url)
    return F.when(
        F.startswith(own, F.lit("/")) & ~F.startswith(own, F.lit("//")), F.concat(F.lit(site.base_url), own)
    ).otherwise(own)


def matches_dated(c: Column | str, site: Site) -> Column:
    return col_(c).rlike(site.dated_pattern)


def post_file_path(url: Column | str, site: Site = Site(), out_dir: str = "_posts") -> Column:
    """``/blog/Y/M/D/slug.html`` to ``out/YYYY-MM-DD-slug.md``; other URLs to ``out/misc-<last>.md``."""

    def part(i: int) -> Column:
        return F.regexp_extract(col_(url), site.dated_pattern, i)

    dated = F.concat(
        F.lit(out_dir + "/"), part(1), F.lit("-"), pad2(part(2)), F.lit("-"), pad2(part(3)), F.lit("-"), part(4), F.lit(".md")
    )
    misc = F.concat(F.lit(out_dir + "/misc-"), strip_token(last_segment(url), ".html"), F.lit(".md"))
    return F.when(part(1) != "", dated).otherwise(misc)


def post_archive_path(url: Column | str, site: Site = Site()) -> Column:
    """Directory of a post inside the archive; month and day keep the URL's spelling, dot segments are resolved."""
    path = _drop_dot_segments(url_path(url))
    return F.concat(F.lit("posts/"), strip_token(strip_token(path, site.section), ".html"))


def base_name(path: Column | str) -> Column:
    return F.regexp_replace(last_segment(path), r"\.md$", "")


def site_url(file_path: Column | str, base: str = "/archive") -> Column:
    """Public URL of a post file; only a numeric ``Y-M-D-`` prefix makes a dated URL."""
    name = base_name(file_path)
    parts = split_n(name, "-", 4)
    dated = F.concat(F.lit(base + "/"), F.array_join(parts, "/"), F.lit("/"))
    return F.when(name.rlike(r"^\d{4}-\d{2}-\d{2}-"), dated).otherwise(F.concat(F.lit(base + "/"), name, F.lit("/")))


def slugify(c: Column | str) -> Column:
    """Lower case, runs of anything but letters and digits to one dash, no dash at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col_(c)), r"[^\p{L}\p{N}]+", "-"), r"^-+|-+$", "")


def permalink(categories: Column | str, file_path: Column | str) -> Column:
    """``/:categories/:year/:month/:day/:title/`` of a dated post file; undated files drop the date."""
    parts = split_n(base_name(file_path), "-", 4)
    dated = base_name(file_path).rlike(r"^\d{4}-\d{2}-\d{2}-")
    tail = F.when(dated, parts).otherwise(F.array(base_name(file_path)))
    cats = F.filter(F.array_distinct(F.transform(col_(categories), slugify)), lambda x: x != "")
    return F.concat(F.lit("/"), F.array_join(F.concat(cats, tail), "/"), F.lit("/"))


def relative_path(target: Column | str, current: Column | str) -> Column:
    """Path of ``target`` as seen from the directory of the file ``current``."""
    goal = F.split(col_(target), "/")
    here = F.split(col_(current), "/")
    depth = F.size(here) - 1
    most = F.least(F.size(goal) - 1, depth)
    shared = F.size(
        F.filter(
            F.sequence(F.lit(1), F.greatest(most, F.lit(1))),
            lambda i: (i <= most) & (F.slice(goal, F.lit(1), i) == F.slice(here, F.lit(1), i)),
        )
    )
    rest = F.slice(goal, shared + 1, F.size(goal) - shared)
    return F.concat(F.repeat(F.lit("../"), depth - shared), F.array_join(rest, "/"))


def relative_url(path: Column | str, base: str = "") -> Column:
    """A site path behind the site's base; absolute URLs stay."""
    prefix = "/" + base.strip("/") if base.strip("/") else ""
    return F.when(col_(path).rlike(HAS_SCHEME), col_(path)).otherwise(
        F.concat(F.lit(prefix + "/"), F.regexp_replace(col_(path), r"^/+", ""))
    )
