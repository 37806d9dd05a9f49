"""Text cleaning, keys and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotledger import settings

# A letter with case that follows anything without case starts a new word.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_WORD_START = rf"(?<=[^{_CASED}])(?=[{_CASED}])"
_BREAK = "\u0001 "


def underscored(text: Column) -> Column:
    """Each run of whitespace becomes one underscore."""
    return F.regexp_replace(text, r"\s+", "_")


def slug_name(name: Column) -> Column:
    return F.lower(underscored(name))


def normalize_channel(channel: Column) -> Column:
    return underscored(F.lower(F.trim(channel)))


def trimmed_lower(text: Column) -> Column:
    return F.lower(F.trim(text))


def uri_part(uri: Column, collection: str) -> Column:
    """The id after ``/collection/`` in a URI: '' when there is none, NULL for a NULL URI."""
    return F.regexp_extract(uri, rf"/{collection}/([^/?]+)", 1)


def invitee_identity(email: Column, name_slug: Column) -> Column:
    return F.coalesce(trimmed_lower(email), trimmed_lower(name_slug), F.lit(settings.UNKNOWN))


def surrogate_key(*parts: Column) -> Column:
    """SHA-256 hex of the parts; NULL parts leave no trace, as earlier keys were built that way."""
    return F.sha2(F.concat_ws(settings.KEY_SEPARATOR, *parts), 256)


def default_unknown(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(settings.UNKNOWN))


def title_case(text: Column) -> Column:
    """Capital letter after every non-letter (``b2b`` -> ``B2B``), the rest lower case.

    ``initcap`` starts words at spaces only, so a marked space goes in at every other word start
    and comes out again afterwards.
    """
    spaced = F.regexp_replace(F.lower(text), _WORD_START, _BREAK)
    return F.replace(F.initcap(spaced), F.lit(_BREAK), F.lit(""))


def _words(text: Column) -> Column:
    return title_case(F.replace(text, F.lit("_"), F.lit(" ")))


def display_channel(channel: Column) -> Column:
    bare = F.replace(channel, F.lit(settings.PAID_ADS_SUFFIX), F.lit(""))
    return F.coalesce(_words(bare), F.lit(settings.UNKNOWN_LABEL))


def display_slot(slot: Column) -> Column:
    return F.coalesce(_words(slot), F.lit(settings.UNKNOWN_LABEL))


def display_hour(hour: Column) -> Column:
    """0 -> 12 AM, 13 -> 1 PM."""
    whole = hour.cast("int")
    on_clock = F.when(whole % 12 == 0, F.lit(12)).otherwise(whole % 12)
    half = F.when(whole < 12, F.lit(" AM")).otherwise(F.lit(" PM"))
    return F.coalesce(F.concat(on_clock.cast("string"), half), F.lit(settings.UNKNOWN_LABEL))


def normalize_email(email: Column) -> Column:
    return F.coalesce(trimmed_lower(email), F.lit(settings.UNKNOWN_LABEL))


def money_text(amount: Column) -> Column:
    return F.coalesce(
        F.concat(F.lit("$"), F.format_number(amount.cast("double"), 2)), F.lit(settings.NOT_AVAILABLE)
    )


def count_text(amount: Column) -> Column:
    return F.coalesce(F.format_number(amount.cast("double"), 0), F.lit(settings.NOT_AVAILABLE))


def metric_text(metric: Column, value: Column) -> Column:
    """Money or plain number, by the metric's name."""
    return F.when(metric.isin(*settings.MONEY_METRICS), money_text(value)).otherwise(count_text(value))
