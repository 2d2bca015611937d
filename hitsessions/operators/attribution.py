"""Attribution rules.

Model 1 moves five values (source, medium, campaign, content, term) from
one event of the session. Two transports exist: the ``*``-joined string
of the original script (N5-N7; a ``*`` inside a value shifts the split
columns) and a struct (no shift).

Model 2 rules are ordered lists of ``(predicate, value)`` folded into one
``CASE``; the first match wins. Users pass their own lists as
:class:`ChannelRules` to the session and report functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitsessions.functions.text import regexp_contains, regexp_extract_or_null, split_keep_empty

# Defaults and labels of the original scripts.
NA = "N/A"
M1_DEFAULTS = {"source": "(direct)", "medium": "(none)", "campaign": "N/A",
               "content": "N/A", "term": "N/A"}
M1_KEYS = ("source", "medium", "campaign", "content", "term")
DELIMITER = "*"
EMPTY_CONCAT = "****"
CLICK_ID_PATTERNS = {"gclid": "gclid=", "fbclid": "fbclid=", "msclid": "msclid=", "hgtid": "hgtid="}
URL_PATTERNS = {
    "utm_campaign_url": r"(?i)utm_campaign=([^&]*)",
    "gclid_url": r"[?&]gclid=([^&]+)",
    "fbclid_url": r"[?&]fbclid=([^&]+)",
    "msclid_url": r"[?&]msclid=([^&]+)",
}


# ---------------------------------------------------------------- Model 1

def concat_attribution(cols: Sequence[Column]) -> Column:
    """``ifnull(a,'') || '*' || ...``, NULL when all five are empty."""
    joined = F.concat_ws(DELIMITER, *[F.coalesce(c, F.lit("")) for c in cols])
    return F.when(joined != F.lit(EMPTY_CONCAT), joined)


def split_attribution(concat: Column) -> list[Column]:
    """Parts 0..4 of the joined string, NULL when out of range."""
    parts = split_keep_empty(concat, DELIMITER)
    return [F.get(parts, i) for i in range(len(M1_KEYS))]


def struct_attribution(cols: Sequence[Column]) -> Column:
    """The five values as one struct, NULL when all are empty."""
    any_value = None
    for c in cols:
        nonempty = F.coalesce(c, F.lit("")) != F.lit("")
        any_value = nonempty if any_value is None else (any_value | nonempty)
    return F.when(any_value, F.struct(*[c.alias(k) for c, k in zip(cols, M1_KEYS)]))


def default_if_empty(c: Column, default: str) -> Column:
    """``CASE WHEN c IS NULL OR c = '' THEN default ELSE c END``."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


# ---------------------------------------------------------------- Model 2

@dataclass(frozen=True)
class Rule:
    """One ``WHEN`` branch: ``when(cols) -> Column`` gives ``value``."""
    when: Callable[[dict], Column]
    value: object
    name: str = ""


def _lit(v, cols: dict) -> Column:
    if isinstance(v, Column):
        return v
    if callable(v):
        return v(cols)
    return F.lit(v)


def fold_rules(rules: Sequence[Rule], cols: dict, otherwise) -> Column:
    out = None
    for r in rules:
        cond, val = r.when(cols), _lit(r.value, cols)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    other = _lit(otherwise, cols)
    return other if out is None else out.otherwise(other)


def has_click_id(name: str) -> Callable[[dict], Column]:
    pat = CLICK_ID_PATTERNS[name]
    return lambda c: regexp_contains(c["page_location"], pat)


def _no_source_no_medium(c: dict) -> Column:
    return (c["source"] == F.lit(NA)) & (c["medium"] == F.lit(NA))


# Source. Unanchored click-id tests, in priority order.
SOURCE_RULES = (
    Rule(has_click_id("gclid"), "google", "gclid"),
    Rule(has_click_id("fbclid"), "facebook", "fbclid"),
    Rule(has_click_id("msclid"), "bing", "msclid"),
    Rule(has_click_id("hgtid"), "heureka.cz", "hgtid"),
    Rule(_no_source_no_medium, "direct", "direct"),
)

# R2: medium. The fbclid test reads the *original* campaign.
MEDIUM_RULES = (
    Rule(has_click_id("gclid"), "cpc", "gclid"),
    Rule(lambda c: has_click_id("fbclid")(c) & (c["campaign"] == F.lit(NA)), "referral", "fbclid"),
    Rule(_no_source_no_medium, "(none)", "direct"),
)

# Campaign, step 1. A gclid visit labelled organic/referral is paid.
CAMPAIGN_RULES = (
    Rule(lambda c: has_click_id("gclid")(c) & c["campaign"].isin("(organic)", "(referral)"), NA, "gclid"),
)


@dataclass(frozen=True)
class ChannelRules:
    """Rule lists of Model 2; the first match of a list wins.

    Add a rule by putting it before or after the built-in ones:
    ``ChannelRules(source=(Rule(...), *SOURCE_RULES))``.
    """
    source: Sequence[Rule] = SOURCE_RULES
    medium: Sequence[Rule] = MEDIUM_RULES
    campaign: Sequence[Rule] = CAMPAIGN_RULES


def url_param(page_location: Column, name: str) -> Column:
    """Group 1 of the URL pattern, ``N/A`` when it does not match."""
    return F.coalesce(regexp_extract_or_null(page_location, URL_PATTERNS[name]), F.lit(NA))


def campaign_with_url_fallback(campaign: Column, utm_campaign_url: Column) -> Column:
    """The URL's utm_campaign when the campaign is ``N/A``."""
    return F.when(campaign == F.lit(NA), utm_campaign_url).otherwise(campaign)


def model2_channel(cols: dict, source_rules=SOURCE_RULES, medium_rules=MEDIUM_RULES,
                   campaign_rules=CAMPAIGN_RULES) -> dict:
    """Source, medium and campaign (steps 1 and 2) of a session_start row."""
    utm = url_param(cols["page_location"], "utm_campaign_url")
    camp1 = fold_rules(campaign_rules, cols, cols["campaign"])
    return {
        "session_source": fold_rules(source_rules, cols, cols["source"]),
        "session_medium": fold_rules(medium_rules, cols, cols["medium"]),
        "session_campaign_step1": camp1,
        "utm_campaign_url": utm,
        "session_campaign": campaign_with_url_fallback(camp1, utm),
    }
