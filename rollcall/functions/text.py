"""Text functions as Column expressions: normalisers, item parts, choice lines, topics, display text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values that results must share with existing meeting data, plainly and in their order.
PREFIXES = (r"^item\s+[0-9]+\s*:\s*", r"^no\.\s*[0-9]+\s*")
LIGHT_SUFFIXES = (r"\s*\(for adoption only\)\s*$", r"\s*\(for presentation\)\s*$", r"\s*expenditure:\s*none\.?\s*$", r"\s*expenditure:\s*\$[0-9,]+\.?\s*$")
SUFFIXES = (*LIGHT_SUFFIXES[:2], r"\s*\(for discussion\)\s*$", *LIGHT_SUFFIXES[2:])
PHRASES = (
    ("consent calendar matters listed under the consent calendar are considered routine and will be enacted by one motion and one vote. there will be no separate discussion of these items. if discussion is desired, that item will be pulled by a councilmember", "consent calendar"),
    ("oral communications #2 (limited up to a 15-minute period) this portion of the meeting is reserved for comments on items that are not on the agenda. under the ralph m. brown act, city council cannot act on items raised during public comment but may res", "oral communications"),
    ("adjournment adjournment of city council meeting to tuesday, october 21, 2025, at 5:00 p.m. for closed session with regular business commencing at 6:30 p.m. in the leroy j. jackson council chamber.", "adjournment"),
    ("adjournment adjournment of city council meeting to tuesday, september 09, 2025, at 5:00 p.m. for closed session with regular business commencing at 6:30 p.m. in the leroy j. jackson council chamber. tuesday, august 26, 2025 and tuesday, september 02,", "adjournment"),
    ("adjournment adjournment of city council meeting to tuesday, august 12, 2025, at 5:00 p.m. for closed session in the leroy j. jackson council chamber.", "adjournment"),
    ("adjournment adjournment of closed session meeting to tuesday, september 23, 2025, at 5:00 p.m. for closed session with regular business commencing at 6:30 p.m. in the leroy j. jackson council chamber.", "adjournment"),
    ("adjournment adjournment of city council meeting to tuesday, october 07, 2025, at 5:00 p.m. for closed session with regular business commencing at 6:30 p.m. in the leroy j. jackson council chamber. tuesday, september 30, 2025 is a city council da", "adjournment"),
    ("adjournment adjournment of city council meeting to tuesday, october 14, 2025, at 5:00 p.m. for closed session in the leroy j. jackson council chamber.", "adjournment"),
    ("council committee meetings and announcements", "council committee meetings"),
)
STARTS = ("consent calendar", "administrative matters", "oral communications", "council committee meetings", "hearings", "adjournment")
CATEGORIES = ("consent calendar", "administrative matters", "hearings", "oral communications", "adjournment", "council committee meetings")
STOP_WORDS = ("THE", "A", "AN", "AND", "OR", "BUT", "IN", "ON", "AT", "TO", "FOR", "OF", "WITH", "BY")
KEY_PHRASES = ("PLANNING COMMISSION", "COMMUNITY DEVELOPMENT", "ORAL COMMUNICATIONS", "ADJOURNMENT", "CONSENT CALENDAR", "HEARINGS", "COUNCIL COMMITTEE", "COMMUNITY SERVICES", "RESOLUTION", "ORDINANCE", "PUBLIC HEARING", "ACCEPT AND FILE")
TOPICS = (
    ("Consent Calendar", ("consent calendar",)), ("Administrative Matters", ("administrative matters",)), ("Planning & Development", ("planning", "development")),
    ("Public Safety", ("fire", "police", "public safety")), ("Budget & Finance", ("finance", "budget", "appropriation")), ("Transportation", ("transit", "transportation")),
    ("Community Services", ("community services", "parks")), ("Environmental", ("environmental", "sustainability")), ("Housing", ("housing", "affordable housing")),
    ("Recognition & Proclamations", ("honoring", "proclamation", "resolution")), ("Public Hearings", ("hearing",)), ("Adjournment", ("adjournment",)), ("Public Comment", ("oral communications",)),
)
OTHER_TOPIC = "Other Business"
NOTABLE = ("budget", "appropriation", "ordinance", "resolution", "contract", "agreement")
RECURRING = ("consent calendar", "adjournment", "administrative matters", "oral communications", "council committee meetings", "hearings")
NOT_VOTABLE = ("oral communications", "adjournment", "presentation only", "for presentation", "announcement", "council committee meetings", "committee meetings and announcements")
INDICATORS = ("voting results", "yea", "nay", "abstain", "recuse", "motion", "resolution", "ordinance", "passes", "fails")
PLACEHOLDERS = ("None", "Not visible in image", "Not visible in the image", "Unknown Agenda Item")
YES, NO, ABSTAIN = ("yea", "y", "yes", "ly"), ("nay", "n", "no", "nl"), ("abstain", "a", "ai", "mal", "mill")
ONE_YES, ONE_NO = ("yea", "y", "yes", "ra", "r"), ("nil", "nl", "n", "na", "nay")
SPACES = "[ \\t\\n\\x0B\\f\\r]+"


def let(x: Column, f) -> Column:
    """f of x, which is worked out once, however often f names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def only_where(x: Column, may, change) -> Column:
    """change(x) where may(x), else x. may is a cheap test that holds wherever change would change anything."""
    return let(x, lambda v: F.when(may(v), change(v)).otherwise(v))


def _blank_end(x: Column, *sides) -> Column:
    """Whether x has white space at its sides (or a line's end of another kind, before which a pattern's $ matches too)."""
    return reduce(lambda a, b: a | b, [side(x, F.lit(1)).isin(*" \t\n\x0b\f\r", "\x85", "\u2028", "\u2029") for side in sides])


def strip(x: Column) -> Column:
    return only_where(x, lambda v: _blank_end(v, F.left, F.right), lambda v: F.regexp_replace(v, f"^{SPACES}|{SPACES}$", ""))


def single_spaces(x: Column) -> Column:
    return only_where(x, lambda v: contains_any(v, ("  ", *"\t\n\x0b\f\r")), lambda v: F.regexp_replace(v, SPACES, " "))


def collapse(x: Column) -> Column:
    return strip(single_spaces(x))


def contains_any(x: Column, terms) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(x, F.lit(t)) for t in terms])


def _without(x: Column, patterns) -> Column:
    return reduce(lambda a, p: F.regexp_replace(a, p, ""), patterns, x)


def _without_remarks(x: Column, suffixes) -> Column:
    """x without item prefixes and closing remarks; every prefix begins with item or no., every remark has a word of its own."""
    x = only_where(x, lambda v: F.startswith(v, F.lit("item")) | F.startswith(v, F.lit("no.")), lambda v: _without(v, PREFIXES))
    return only_where(x, lambda v: contains_any(v, ("(for ", "expenditure:")), lambda v: _without(v, suffixes))


def normalise_light(x: Column) -> Column:
    """Lower case without item prefixes and closing remarks; white space is collapsed last. Null is the empty text."""
    return single_spaces(_without_remarks(strip(F.lower(F.coalesce(x, F.lit("")))), LIGHT_SUFFIXES))


def normalise_discussion(x: Column) -> Column:
    """As normalise_light, with white space collapsed first and remarks for discussion removed too."""
    return _without_remarks(single_spaces(strip(F.lower(F.coalesce(x, F.lit(""))))), SUFFIXES)


def normalise_phrases(x: Column) -> Column:
    whole = lambda v: reduce(lambda a, p: F.replace(a, F.lit(p[0]), F.lit(p[1])), PHRASES, v)
    return only_where(normalise_discussion(x), lambda v: contains_any(v, [p for p, _ in PHRASES]), whole)


def normalise_aggressive(x: Column) -> Column:
    """Without a leading number and a leading letter (the dot is optional, so the first letter of any text goes),
    parentheses and what follows an expenditure."""
    out = only_where(normalise_phrases(x), lambda v: F.left(v, F.lit(1)).between("0", "9"), lambda v: F.regexp_replace(v, r"^[0-9]+[a-z]?\s*\.?\s*", ""))
    out = F.regexp_replace(out, r"^[a-z]\s*\.?\s*", "")
    out = only_where(out, lambda v: F.contains(v, F.lit("(")), lambda v: F.regexp_replace(v, r"\s*\(.*?\)\s*", " "))
    out = only_where(out, lambda v: F.contains(v, F.lit("expenditure:")), lambda v: F.regexp_replace(v, r"\s*expenditure:.*$", ""))
    return only_where(out, lambda v: _blank_end(v, F.right), lambda v: F.regexp_replace(v, r"\s*$", ""))


def with_ultra(df: DataFrame, x: str, out: str) -> DataFrame:
    """df with out: normalise_aggressive cut to its category, '' where there is no text; the chain of patterns stands once in
    the plan."""
    done = df.withColumn(out, normalise_aggressive(F.col(x)))
    found = F.when(F.length(out) < 3, F.lit("generic item"))
    for c in STARTS:
        found = found.when(F.startswith(out, F.lit(c)), F.lit(c))
    return done.withColumn(out, F.when(F.coalesce(F.col(x), F.lit("")) == "", "").otherwise(found.otherwise(F.col(out))))


def with_category(df: DataFrame, x: str, out: str) -> DataFrame:
    """df with out: the first category that the collapsed lower-case text holds, else this text."""
    done = df.withColumn(out, collapse(F.lower(F.coalesce(F.col(x), F.lit("")))))
    found = F.when(F.contains(out, F.lit(CATEGORIES[0])), F.lit(CATEGORIES[0]))
    for c in CATEGORIES[1:]:
        found = found.when(F.contains(out, F.lit(c)), F.lit(c))
    return done.withColumn(out, found.otherwise(F.col(out)))


def match_words(x: Column) -> Column:
    """Upper-case words without punctuation and stop words, for matching. Letters and digits of any script stay."""
    flat = only_where(F.upper(F.coalesce(x, F.lit(""))), lambda v: v.rlike("[^ -~]"), lambda v: F.regexp_replace(v, r"(?U)\s+", " "))
    return F.filter(F.split(F.regexp_replace(flat, r"[^\p{L}\p{N}_ ]", ""), " "), lambda w: ~w.isin("", *STOP_WORDS))


def normalise_match(x: Column) -> Column:
    """match_words as one text."""
    return F.array_join(match_words(x), " ")


def key_number(x: Column) -> Column:
    """The leading item number, null if there is none."""
    return F.when(F.left(x, F.lit(1)).between("0", "9"), F.nullif(F.regexp_extract(x, r"^([0-9]+[A-Z]?)\s*\.", 1), F.lit("")))


def phrase_bits(upper: Column) -> Column:
    """A bit for each known phrase that an upper-case text holds. No phrase has a dot, so a leading number takes part in none."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.contains(upper, F.lit(p)), F.lit(1 << k)).otherwise(F.lit(0)) for k, p in enumerate(KEY_PHRASES)])


def key_phrases(x: Column) -> Column:
    """The leading item number, if any, and the known phrases in the title, in their order."""
    known = let(F.upper(x), lambda u: F.array(*[F.when(F.contains(u, F.lit(p)), F.lit(p)) for p in KEY_PHRASES]))
    return F.array_compact(F.concat(F.array(key_number(x)), known))


def with_match_parts(df: DataFrame, x: str, out: str, item: bool, needed: Column | None = None) -> DataFrame:
    """df with out: what of an item's or a marker's text is compared with the other's, that is its distinct words for matching, the
    text and the length of all of them, its number and known phrases (of a marker those in the words). It is null where it is not needed."""
    new = lambda e: e if needed is None else F.when(needed, e)
    text = F.coalesce(F.col(x), F.lit(""))
    done = df.withColumn("_w", new(match_words(text))).withColumn("_t", new(F.array_join("_w", " "))).withColumn("_u", new(F.upper(text)) if item else F.col("_t"))
    own = {"number": key_number(text)} if item else {"text": F.col("_t")}
    parts = {"words": F.array_distinct("_w"), "n": F.length("_t"), "phrases": phrase_bits(F.col("_u"))} | own
    return done.withColumn(out, new(F.struct(*[e.alias(k) for k, e in parts.items()]))).drop("_w", "_t", "_u")


def topic(x: Column) -> Column:
    """The first topic one of whose words the text holds."""
    t = F.lower(F.coalesce(x, F.lit("")))
    found = F.when(contains_any(t, TOPICS[0][1]), F.lit(TOPICS[0][0]))
    for name, words in TOPICS[1:]:
        found = found.when(contains_any(t, words), F.lit(name))
    return found.otherwise(F.lit(OTHER_TOPIC))


def notable(item: Column, outcome: Column) -> Column:
    """What is told of a notable ballot; null for others."""
    o = F.lower(F.coalesce(outcome, F.lit("")))
    short = F.concat(F.substring(item, 1, 60), F.lit("..."))
    said = F.when(F.contains(o, F.lit("pass")), F.concat(F.lit("Approved "), short)).when(F.contains(o, F.lit("fail")), F.concat(F.lit("Rejected "), short))
    return F.when(contains_any(F.lower(item), NOTABLE), said)


def truncated(x: Column) -> Column:
    """Whether an item's text is cut off or a placeholder."""
    t = F.coalesce(x, F.lit(""))
    return (F.length(t) <= 5) | F.endswith(t, F.lit("...")) | t.isin(*PLACEHOLDERS)


def not_votable(x: Column) -> Column:
    return F.coalesce(contains_any(F.lower(x), NOT_VOTABLE), F.lit(False))


def item_number(x: Column) -> Column:
    return F.trim(F.substring_index(x, ".", 1))


def choice(token: Column) -> Column:
    t = F.lower(token)
    return F.when(t.isin(*YES), F.lit("YES")).when(t.isin(*NO), F.lit("NO")).when(t.isin(*ABSTAIN), F.lit("ABSTAIN")).otherwise(F.upper(t))


def choice_rows(df: DataFrame, keys: list[str], text: str, names: Column | None = None) -> DataFrame:
    """keys, member and choice from lines `councilmember <name> <token>`; a later line of a member wins.

    names: a map of lower-case names to canonical ones; a name that it lacks stays in upper case."""
    lines = df.select(*keys, F.posexplode(F.split(F.lower(text), "\n")).alias("_at", "_line"))
    pattern = r"^\s*councilmember\s+([A-Za-z0-9_]+)\s+([a-z]+)"
    found = lines.withColumn("_m", F.regexp_extract("_line", pattern, 1)).where("_m <> ''").withColumn("_t", F.regexp_extract("_line", pattern, 2))
    name = F.upper("_m") if names is None else F.coalesce(names[F.col("_m")], F.upper("_m"))
    return found.groupBy(*keys, name.alias("member")).agg(choice(F.max_by("_t", "_at")).alias("choice"))


def one_choice(text: Column, surname: str) -> Column:
    """The choice told after a member's surname in the first line that has it; unclear ones abstain."""
    line = F.filter(F.split(F.lower(text), "\n"), lambda x: F.contains(x, F.lit(surname)))
    token = strip(F.split(F.get(line, F.lit(0)), surname)[1])
    return F.when(F.size(line) > 0, F.when(token.isin(*ONE_NO), "NO").when(token.isin(*ONE_YES), "YES").otherwise("ABSTAIN"))


def markdown_links(x: Column) -> Column:
    return F.regexp_replace(x, r"\[([^\]]+)\]\(([^)]+)\)", '<a href="$2">$1</a>')


def csv_quote(x: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))


def truncate(x: Column, n: int) -> Column:
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("..."))).otherwise(x)


def percent(part: Column, whole: Column) -> Column:
    """Per mille rounded half up as text with one decimal; no rows give 0%."""
    tenths = F.floor((F.lit(2000) * part + whole) / (2 * F.nullif(whole, F.lit(0)))).cast("long")
    return F.when(whole == 0, F.lit("0%")).otherwise(F.concat((tenths / 10).cast("long").cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"), F.lit("%")))
