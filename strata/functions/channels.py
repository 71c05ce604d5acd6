"""Acquisition-channel expressions (Column -> Column).

A visit belongs to exactly one acquisition type, decided in this order:
a campaign source is set -> paid; else a referrer is set -> organic; else
direct.  Empty strings count as "set"; only NULL means absent.

All functions return plain Catalyst expressions (CASE WHEN, regexp_extract,
concat), so they stay inside whole-stage codegen and cost nothing extra to
plan; none of them needs a UDF.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._cols import as_col

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference pipeline's output strings for
# results to match; they are stated here once, in natural order.
# ---------------------------------------------------------------------------
PAID = "Payant"
ORGANIC = "Naturel"
DIRECT = "Direct"
CHANNEL_TYPES = (PAID, ORGANIC, DIRECT)

SOURCE_LABELS = {
    "gsearch": "Google",
    "bsearch": "Bing",
    "socialbook": "Socialbook",
}
CAMPAIGN_LABELS = {
    "nonbrand": "acquisition",
    "brand": "marque",
    "desktop_targeted": "ciblage desktop",
    "pilot": "pilote",
}

PAID_SEPARATOR = " Ads · "
ORGANIC_SUFFIX = " · naturel"
DIRECT_LABEL = "Accès direct"

# Host label of a referrer URL: first run of characters after the scheme
# and an optional "www.", up to the next "/" or ".". Find semantics (not a
# full match), case-sensitive.
REFERER_HOST_PATTERN = r"https?://(?:www\.)?([^/.]+)"
# ---------------------------------------------------------------------------


def acquisition_type(source="utm_source", referer="http_referer") -> Column:
    """``Payant`` if the source is set, else ``Naturel`` if a referrer is
    set, else ``Direct``."""
    return (
        F.when(as_col(source).isNotNull(), F.lit(PAID))
        .when(as_col(referer).isNotNull(), F.lit(ORGANIC))
        .otherwise(F.lit(DIRECT))
    )


def referer_host(referer="http_referer") -> Column:
    """host label of a referrer URL; ``""`` when the pattern does not
    occur, NULL when the input is NULL."""
    return F.regexp_extract(as_col(referer), REFERER_HOST_PATTERN, 1)


def label_of(value, mapping: Mapping[str, str]) -> Column:
    """replace known codes by their label and pass anything else through.

    NULL stays NULL. The mapping becomes one literal map expression, looked
    up per row (no join, no UDF). An empty mapping is the identity.
    """
    col = as_col(value)
    if not mapping:
        return col
    pairs = []
    for code, label in mapping.items():
        pairs += [F.lit(code), F.lit(label)]
    return F.coalesce(F.create_map(*pairs)[col], col)


def channel_label(
    source="utm_source",
    campaign="utm_campaign",
    referer="http_referer",
    *,
    source_labels: Mapping[str, str] = SOURCE_LABELS,
    campaign_labels: Mapping[str, str] = CAMPAIGN_LABELS,
    unknown_label: str | None = None,
    host=None,
) -> Column:
    """readable channel name.

    paid     ``"<source label> Ads · <campaign label>"``
    organic  ``"<referrer host label> · naturel"``
    direct   ``"Accès direct"``

    ``concat`` is NULL when any part is NULL, so a paid visit without a
    campaign gets a NULL channel (and its conversions are not attributed,
    see ``channel_performance``). Pass ``unknown_label`` to put that text in
    place of a missing part instead. ``host`` may name a column that already
    holds ``referer_host(referer)``, so the pattern runs once per row.
    """
    src = label_of(source, source_labels)
    cmp = label_of(campaign, campaign_labels)
    host = label_of(referer_host(referer) if host is None else as_col(host), source_labels)
    if unknown_label is not None:
        src = F.coalesce(src, F.lit(unknown_label))
        cmp = F.coalesce(cmp, F.lit(unknown_label))
        host = F.coalesce(host, F.lit(unknown_label))
    kind = acquisition_type(source, referer)
    return (
        F.when(kind == PAID, F.concat(src, F.lit(PAID_SEPARATOR), cmp))
        .when(kind == ORGANIC, F.concat(host, F.lit(ORGANIC_SUFFIX)))
        .otherwise(F.lit(DIRECT_LABEL))
    )
