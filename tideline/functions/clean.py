"""Cleaning of dirty text columns: person key, safe casts, categories, statuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_DIGITS = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- person key ------------------------------------------------------------------


def digits(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


def phone9(c: Column | str) -> Column:
    """Last nine digits of the digits-only text; shorter text passes through, NULL stays NULL."""
    if isinstance(c, str):
        return F.expr(f"right(regexp_replace(`{c}`, '[^0-9]', ''), {KEY_DIGITS})")
    return F.right(digits(c), F.lit(KEY_DIGITS))


def phone9_from_numeric_text(c: Column | str) -> Column:
    """Same key for numbers that came through a float column (``2782….0``)."""
    return phone9(F.split_part(_col(c).cast("string"), F.lit("."), F.lit(1)))


def has_phone(c: Column | str, exact: bool = False) -> Column:
    """``exact``: the key itself has nine characters. Otherwise: raw text has at least nine digits."""
    if exact:
        return F.length(_col(c)) == KEY_DIGITS
    return F.length(digits(c)) >= KEY_DIGITS


def e164(key: Column | str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), _col(key))


def is_mobile(key: Column | str, pattern: str) -> Column:
    """Whole-string match: ``rlike`` alone would accept a match anywhere."""
    return _col(key).rlike(f"^(?:{pattern})$")


# ---- safe casts ------------------------------------------------------------------


def try_number(c: Column | str) -> Column:
    """Text to a whole number, rounded half up; anything else is NULL."""
    return F.trim(_col(c)).try_cast("decimal(38,0)")


def money(*parts: Column | str) -> Column:
    """Sum of whole-unit amounts, unreadable parts count as zero."""
    total = F.lit(0.0)
    for part in parts:
        total = total + F.coalesce(try_number(part).cast("double"), F.lit(0.0))
    return total


def ts(c: Column | str) -> Column:
    """ISO text to a zone-less timestamp, NULL when unreadable."""
    return _col(c).cast("string").try_cast("timestamp_ntz")


def ts_or_nanos(c: Column | str) -> Column:
    """ISO text, else a count of nanoseconds since 1970."""
    text = _col(c).cast("string")
    # A pure number is never a date here, although Spark would read '2024' as a year.
    number = F.when(text.rlike("^[0-9]{8,19}$"), text.try_cast("decimal(20,0)"))
    seconds = (number / F.lit(1_000_000_000)).cast("decimal(18,6)")
    from_nanos = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.when(number.isNull(), text.try_cast("timestamp_ntz")).otherwise(from_nanos)


def try_double(c: Column | str) -> Column:
    return F.trim(_col(c)).try_cast("double")


def try_int(c: Column | str) -> Column:
    """Goes through decimal so that ``'200.0'`` is 200, which ANSI text-to-int refuses."""
    return F.trim(_col(c)).try_cast("decimal(38,6)").try_cast("int")


# Words read as a truth value
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")


def try_bool(c: Column | str) -> Column:
    word = F.lower(F.trim(_col(c).cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def template_id(c: Column | str, width: int = 5) -> Column:
    """Trim, drop a float tail, pad with zeros; longer ids are kept whole."""
    text = F.regexp_replace(F.trim(_col(c).cast("string")), r"\.0$", "")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


# ---- categories ------------------------------------------------------------------


def cat(c: Column | str, default: str = "unknown") -> Column:
    return F.lower(F.coalesce(_col(c), F.lit(default)))


def alnum_key(c: Column | str) -> Column:
    return F.upper(F.regexp_replace(_col(c), "[^A-Za-z0-9]", ""))


def channel_key(source: Column | str, sub: Column | str, full: Column | str) -> Column:
    """Lead providers are told apart by their sub-source, all others by the full source."""
    return F.when(_col(source) == "lead_provider", _col(sub)).otherwise(_col(full))


def clean_name(first: Column | str, last: Column | str, bad_names: Sequence[str] = ()) -> Column:
    """Both names present and real. ``bad_names`` holds upper-case full names of test people."""
    f, l = F.trim(_col(first)), F.trim(_col(last))
    ok = (f != "") & (l != "") & (F.lower(f) != "nofirstname") & (F.lower(l) != "nolastname")
    if bad_names:
        ok = ok & ~F.upper(F.concat_ws(" ", f, l)).isin(*bad_names)
    return F.coalesce(ok, F.lit(False))


# Call outcomes, by class; patterns are case-insensitive
OUTCOME_CLASSES = (
    ("dnc", ("Do Not Call%",), ()),
    ("sale_made", ("Sale Made%",), ()),
    ("existing_policyholder", ("%Existing%Policyholder%",), ()),
    ("no_insurable_risk", ("%No Insurable Risk%",), ()),
    ("callback_scheduled", ("Callback Scheduled%",), ()),
    ("auto_disconnected", ("%Disconnect%",), ()),
    ("never_connected", (), ("Not Reached", "No Answer Autodial", "Auto Engaged", "Voicemail")),
)
FOLDED_CLASSES = ("dnc", "sale_made", "existing_policyholder", "no_insurable_risk")
CALLBACK_PATTERN = "Callback Scheduled%"
SALE_PATTERN = "Sale Made%"


def matches(c: Column | str, patterns: Sequence[str] = (), names: Sequence[str] = ()) -> Column:
    """Any case-insensitive pattern or any exact name; NULL input is not a match."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | _col(c).ilike(pattern)
    if names:
        hit = hit | _col(c).isin(*names)
    return F.coalesce(hit, F.lit(False))


def outcome_group(c: Column | str, fold: bool = False) -> Column:
    """Class of the last call outcome; first matching class wins. ``fold`` merges the closed ones."""
    if isinstance(c, str):  # one SQL text instead of a call per pattern
        whens = []
        for label, patterns, names in OUTCOME_CLASSES:
            shown = "other_connected" if fold and label in FOLDED_CLASSES else label
            tests = [f"`{c}` ilike '{p}'" for p in patterns] + ([f"`{c}` in ({', '.join(repr(n) for n in names)})"] if names else [])
            whens.append(f"when {' or '.join(tests)} then '{shown}'")
        return F.expr(f"case when `{c}` is null then 'no_prior_call' {' '.join(whens)} else 'other_connected' end")
    out = F.when(_col(c).isNull(), F.lit("no_prior_call"))
    for label, patterns, names in OUTCOME_CLASSES:
        shown = "other_connected" if fold and label in FOLDED_CLASSES else label
        out = out.when(matches(c, patterns, names), F.lit(shown))
    return out.otherwise(F.lit("other_connected"))


def fold_outcome(group: Column | str) -> Column:
    return F.when(_col(group).isin(*FOLDED_CLASSES), F.lit("other_connected")).otherwise(_col(group))


def send_status(read: Column | str, delivered: Column | str, failed: Column | str) -> Column:
    """Furthest status of a message from its 0/1 flags."""
    return (
        F.when(_col(read) == 1, F.lit("read"))
        .when(_col(delivered) == 1, F.lit("delivered"))
        .when(_col(failed) == 1, F.lit("failed"))
        .otherwise(F.lit("sent"))
    )


def prev_status(campaign: Column, sent: Column, read: Column, delivered: Column, failed: Column) -> Column:
    """What became of the previous discount message."""
    return (
        F.when(campaign.isNull(), F.lit("none"))
        .when(sent.isNull(), F.lit("no_twilio_record"))
        .when(read == 1, F.lit("read"))
        .when(delivered == 1, F.lit("delivered_not_read"))
        .when(failed == 1, F.lit("failed"))
        .otherwise(F.lit("sent_no_status"))
    )


def phone_first(days_since_callback: Column | str, days_since_lead: Column | str, days: int) -> Column:
    """Held for a phone call: a scheduled callback or a new lead in the last days."""
    recent = (_col(days_since_callback) <= days) | (_col(days_since_lead) <= days)
    return F.coalesce(recent, F.lit(False))


def batch_label(campaign: Column | str) -> Column:
    """Bulk campaigns are their own batch, daily picks are grouped by calendar month."""
    name = _col(campaign)
    return F.when(name.startswith("CPC_"), F.left(name, F.lit(10))).otherwise(name)
