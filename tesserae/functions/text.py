"""Text, identifier and version functions as columns; all run inside whole-stage codegen unless a note says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(c: Column) -> Column:
    """Lower case without anything but ASCII letters and digits."""
    return F.regexp_replace(F.lower(c), "[^a-zA-Z0-9]", "")


def same_but_for_case(a: Column, b: Column) -> Column:
    return normalized(a) == normalized(b)


def split_packed(c: Column, mark: str = ";") -> Column:
    """Parts of a packed list, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, mark), lambda x: F.trim(x)), lambda x: x != "")


def joined(c: Column, mark: str = "; ") -> Column:
    return F.array_join(c, mark)


def expand_curie(c: Column, prefixes: dict[str, str]) -> Column:
    """prefix:rest -> the prefix's address and rest; http(s) addresses and unknown prefixes pass."""
    known = F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair])
    base = known[F.substring_index(c, ":", 1)]
    inside = c.contains(":") & ~c.rlike("^https?://") & base.isNotNull()
    return F.when(inside, F.concat(base, F.regexp_replace(c, "^[^:]*:", ""))).otherwise(c)


def encoded_twice(c: Column) -> Column:
    """Percent-encoded twice, a space as %20."""
    once = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return F.replace(F.url_encode(once), F.lit("+"), F.lit("%20"))


def last_segment(c: Column, mark: str = "/") -> Column:
    return F.substring_index(c, mark, -1)


def local_name(c: Column) -> Column:
    """What follows the last # or /, percent-decoded; + stays."""
    rest = F.regexp_extract(c, "([^#/]*)$", 1)
    return F.coalesce(F.try_url_decode(F.replace(rest, F.lit("+"), F.lit("%2B"))), rest)


def shortened(c: Column, prefixes: dict[str, str], most: int = 200) -> Column:
    """address of the first matching prefix -> prefix:rest; other texts are cut after `most` characters."""
    out = F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("..."))).otherwise(c)
    for name, base in reversed(prefixes.items()):
        out = F.when(c.startswith(base), F.concat(F.lit(f"{name}:"), F.substr(c, F.lit(len(base) + 1)))).otherwise(out)
    return out


def _apart(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2"), "([A-Z]+)([A-Z][a-z])", "$1 $2")


def humanized(c: Column) -> Column:
    """CamelCase as words, without a closing Template."""
    return _apart(F.regexp_replace(c, "Template$", ""))


def humanized_enum(c: Column) -> Column:
    """CamelCase as words, without a closing Enum."""
    return _apart(F.regexp_replace(c, "Enum$", ""))


def is_true(c: Column) -> Column:
    return F.coalesce(c.isin("true", "1"), F.lit(False))


def data_type(template: Column, folder: Column) -> Column:
    return F.concat(F.regexp_replace(template, "Template$", ""), F.lit("-"), folder)


def template_of(uri: Column) -> Column:
    """First part between dots of an address that names a template; null if none does."""
    return F.get(F.filter(F.split(uri, "[.]"), lambda x: x.contains("Template")), F.lit(0))


def schema_id(id: Column) -> Column:
    """struct<org, name> of a registered schema's id, without a numeric version."""
    bare = F.regexp_replace(F.regexp_extract(id, "([^/]*)$", 1), r"-[0-9]+(\.[0-9]+)*$", "")
    return F.struct(F.regexp_extract(bare, "^([^-]*)-", 1).alias("org"), F.regexp_extract(bare, "^[^-]*-(.*)$", 1).alias("name"))


def id_parts(id: Column) -> Column:
    """struct<org, name> of an id cut at its first dash; null unless both parts hold something."""
    cut = F.split(id, "-", 2)
    return F.when((F.size(cut) == 2) & (F.trim(cut[0]) != "") & (F.trim(F.get(cut, F.lit(1))) != ""), F.struct(cut[0].alias("org"), F.get(cut, F.lit(1)).alias("name")))


def rrid(c: Column) -> Column:
    """RRID:x and rrid:x stay, bare ids get rrid:, blank is null."""
    bare = F.trim(c)
    return F.when(bare == "", None).when(F.lower(bare).startswith("rrid:"), bare).otherwise(F.concat(F.lit("rrid:"), bare))


def useful_description(description: Column, name: Column) -> Column:
    """The description unless it is blank or only the name."""
    bare = F.trim(description)
    return F.when((bare != "") & (bare != F.trim(name)), bare)


def version(c: Column) -> Column:
    """a.b.c as an array of three numbers that sorts in order; anything else counts as 0.0.0."""
    parts = F.transform(F.split(c, r"\."), lambda x: x.try_cast("int"))
    zero = F.array(F.lit(0), F.lit(0), F.lit(0))
    return F.when(c.rlike(r"^[0-9]{1,9}\.[0-9]{1,9}\.[0-9]{1,9}$"), parts).otherwise(zero)


def first_sentence(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def term_address(c: Column) -> Column:
    """Whether a text is the address of a vocabulary's term: http or https, and none of the sites below."""
    # fixed values
    skipped = ["creativecommons.org", "ror.org", "identifiers.org/RRID"]
    out = c.startswith("http://") | c.startswith("https://")
    for site in skipped:
        out = out & ~c.contains(site)
    return F.coalesce(out, F.lit(False))


def unwrapped(c: Column, name: str = "string") -> Column:
    """x of name(x); null if it has another form."""
    found = F.regexp_extract(c, rf"^{name}\((.*)\)$", 1)
    return F.when(c.rlike(rf"^{name}\(.*\)$"), found)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(part / whole * 100, digits)


def escaped_html(c: Column) -> Column:
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def display_date(c: Column) -> Column:
    return F.date_format(c, "MMMM d, yyyy")
