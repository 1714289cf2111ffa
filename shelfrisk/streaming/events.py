"""Event contract: validate (one reason per record) and enrich.

Pure Column logic over ``try_parse_json`` VARIANT values, so the same
functions run in a batch DataFrame, inside ``foreachBatch`` or directly in a
streaming plan, JVM-side with no Python UDF. The first failing rule gives
the reason, in this order:

  invalid json -> not an object -> missing common fields -> unknown type ->
  malformed store_id -> malformed product_id -> event_ts not a string /
  not ISO-8601 -> missing type fields -> value rules

Type tests read the VARIANT's own type: quantities must be JSON integers
(``3``, not ``3.0``, ``"3"`` or ``true``); prices any JSON number.

An event may carry fields beyond its contract. They are kept as they are in ``extra``, the JSON text of the object's
remainder, beside the typed columns (NULL if there are none); names that enrichment sets itself are replaced by it.

Records may come in envelopes, ``{"kinesis": {"data": <base64>}}``. ``opened`` takes the payload out; a record that
cannot be opened is rejected with the payload as it came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrisk.functions.numeric import round_half_away
from shelfrisk.sources.schemas import (
    COMMON_EVENT_FIELDS,
    EVENT_TYPES,
    STREAM_PRODUCT_ID_PATTERN,
    STREAM_STORE_ID_PATTERN,
    TYPE_EVENT_FIELDS,
)

# ISO-8601: a calendar date or a week date, each extended or basic; then, after any one character, a time of two-digit
# parts, extended or basic, with a fraction of any length after '.' or ','; then an offset of less than a day, whose minutes
# and seconds may be any two digits (and before which a fraction may be empty). Z is read as +00:00 first.
ISO_DATE = r"\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}-\d(?!\d)|\d{4}-W\d{2}|\d{4}W\d{2}\d|\d{4}W\d{2}"


def _parts(hour: str, *rest: str, fraction: str) -> str:
    """Hour, then minutes, then seconds with a fraction, each optional: with colons or without."""
    forms = []
    for colon in (":", ""):
        tail = f"(?:[.,]{fraction})?"
        for part in reversed(rest):
            tail = f"(?:{colon}{part}{tail})?"
        forms.append(hour + tail)
    return f"(?:{'|'.join(forms)})"


_HOUR, _SIXTY, _ANY = r"(?:[01]\d|2[0-3])", r"[0-5]\d", r"\d\d"
_CLOCK = _parts(_HOUR, _SIXTY, _SIXTY, fraction=r"\d+")
_CLOCK_BEFORE_OFFSET = _parts(_HOUR, _SIXTY, _SIXTY, fraction=r"\d*")
_OFFSET = f"(?:{_parts(r'(?:[01][0-9]|2[0-2])', _ANY, _ANY, fraction='[0-9]+')}|{_parts('23', '(?:[0-4][0-9]|5[0-8])', _ANY, fraction='[0-9]+')}|23:59(?::{_SIXTY}(?:[.,][0-9]+)?)?|2359(?:{_SIXTY}(?:[.,][0-9]+)?)?)"
ISO_TIMESTAMP_PATTERN = rf"^(?:{ISO_DATE})(?:[\s\S](?:{_CLOCK}|{_CLOCK_BEFORE_OFFSET}[+-]{_OFFSET}))?\z"
PARSED = "_event"


FIELDS = COMMON_EVENT_FIELDS + TYPE_EVENT_FIELDS["pos_sale"] + TYPE_EVENT_FIELDS["inventory_update"]
NUMERIC_FIELDS = TYPE_EVENT_FIELDS["pos_sale"] + TYPE_EVENT_FIELDS["inventory_update"]
INTEGER_FIELDS = tuple(f for f in NUMERIC_FIELDS if f != "unit_price")


def written_date(stamp: Column) -> Column:
    """The DATE written in an ISO-8601 stamp, in the stamp's own offset; NULL if it is no date.

    Week dates: day 1 is Monday (also if no day is given), week 1 is the one with January 4th.
    """
    digits = F.replace(F.regexp_extract(stamp, rf"^(?:{ISO_DATE})", 0), F.lit("-"), F.lit(""))
    part = lambda start, size: F.substring(digits, start, size)
    calendar = F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2)).try_cast("date")
    fourth = F.concat(part(1, 4), F.lit("-01-04")).try_cast("date")
    week, day = part(6, 2).try_cast("int"), F.coalesce(F.nullif(part(8, 1), F.lit("")).try_cast("int"), F.lit(1))
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)
    in_year = (F.weekofyear(monday) == week) & day.between(1, 7)  # also tells years with a 53rd week
    by_week = F.when(in_year, F.date_add(monday, day - 1))
    return F.when(part(1, 4) != "0000", F.when(part(5, 1) == "W", by_week).otherwise(calendar))


def _field(name: str) -> Column:
    return F.try_variant_get(F.col(PARSED), f"$.{name}", "variant")


def _type_of(name: str) -> Column:
    return F.col(f"_t_{name}")


def _text(name: str) -> Column:
    return F.col(f"_s_{name}")


def _number(name: str) -> Column:
    return F.col(f"_n_{name}")


def _missing(name: str) -> Column:
    return _type_of(name).isNull() | (_type_of(name) == "VOID")


def _missing_list(fields: tuple[str, ...]) -> Column:
    names = F.filter(F.array(*[F.when(_missing(f), F.lit(f)) for f in fields]),
                     lambda x: x.isNotNull())
    return F.when(F.size(names) > 0, F.concat(F.lit("missing fields: "),
                                              F.array_join(names, ", ")))


def _repr(name: str) -> Column:
    """Display a field the way the contract messages quote it."""
    return F.when(_type_of(name) == "STRING", F.concat(F.lit("'"), _text(name), F.lit("'"))) \
        .otherwise(F.to_json(_field(name)))


def _is_integer(name: str) -> Column:
    return _type_of(name) == "BIGINT"


def _is_number(name: str) -> Column:
    t = _type_of(name)
    return t.isin("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT") | t.startswith("DECIMAL")


def parse(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse once, then extract each contract field once.

    Adds the VARIANT (NULL for text that is not valid JSON), whether it is an
    object, and per field its VARIANT type name (NULL when absent, VOID for a
    JSON null); the envelope fields' text; the quantities' and price's number.
    The rules below read these columns, so no field is extracted twice.
    """
    parsed = df.withColumn(PARSED, F.try_parse_json(F.col(value_col)))
    cols = {"_is_object": F.schema_of_variant(F.col(PARSED)).startswith("OBJECT")}
    for f in FIELDS:
        cols[f"_t_{f}"] = F.schema_of_variant(_field(f))
    for f in COMMON_EVENT_FIELDS:
        cols[f"_s_{f}"] = F.try_variant_get(F.col(PARSED), f"$.{f}", "string")
    for f in NUMERIC_FIELDS:
        kind = "bigint" if f in INTEGER_FIELDS else "double"
        cols[f"_n_{f}"] = F.try_variant_get(F.col(PARSED), f"$.{f}", kind)
    return parsed.withColumns(cols)


def _helper_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == PARSED or c == "_is_object" or c[:3] in ("_t_", "_s_", "_n_")]


def reason(value_col: str = "value") -> Column:
    """Rejection reason of a parsed record (see ``parse``), NULL when valid."""
    v = F.col(PARSED)
    etype = _text("event_type")
    ts_text = _text("event_ts")
    iso = F.replace(ts_text, F.lit("Z"), F.lit("+00:00"))
    ts_ok = iso.rlike(ISO_TIMESTAMP_PATTERN) & written_date(iso).isNotNull()
    store_text = F.coalesce(_text("store_id"), F.to_json(_field("store_id")))
    product_text = F.coalesce(_text("product_id"), F.to_json(_field("product_id")))
    sale_missing = _missing_list(TYPE_EVENT_FIELDS["pos_sale"])
    stock_missing = _missing_list(TYPE_EVENT_FIELDS["inventory_update"])
    common_missing = _missing_list(COMMON_EVENT_FIELDS)
    is_sale = etype == "pos_sale"

    def non_negative_int(name: str) -> Column:
        return _is_integer(name) & (_number(name) >= 0)

    return (
        F.when(v.isNull(), F.lit("invalid json"))
        .when(~F.col("_is_object"), F.lit("event is not a JSON object"))
        .when(common_missing.isNotNull(), common_missing)
        .when((_type_of("event_type") != "STRING") | ~etype.isin(*EVENT_TYPES),
              F.concat(F.lit("unknown event_type: "), _repr("event_type")))
        .when(~store_text.rlike(STREAM_STORE_ID_PATTERN),
              F.concat(F.lit("malformed store_id: "), _repr("store_id")))
        .when(~product_text.rlike(STREAM_PRODUCT_ID_PATTERN),
              F.concat(F.lit("malformed product_id: "), _repr("product_id")))
        .when(_type_of("event_ts") != "STRING", F.lit("event_ts must be an ISO-8601 string"))
        .when(~ts_ok, F.concat(F.lit("event_ts is not valid ISO-8601: "), ts_text))
        .when(is_sale & sale_missing.isNotNull(), sale_missing)
        .when(~is_sale & stock_missing.isNotNull(), stock_missing)
        .when(is_sale & ~(_is_integer("units") & (_number("units") > 0)),
              F.lit("units must be a positive integer"))
        .when(is_sale & ~(_is_number("unit_price") & (_number("unit_price") > 0)),
              F.lit("unit_price must be a positive number"))
        .when(~is_sale & ~non_negative_int("on_hand_qty"),
              F.lit("on_hand_qty must be a non-negative integer"))
        .when(~is_sale & ~non_negative_int("received_qty"),
              F.lit("received_qty must be a non-negative integer"))
    )


def with_reason(df: DataFrame, value_col: str = "value", fault_col: str | None = None) -> DataFrame:
    """Parse and tag every record with its rejection reason (NULL = valid). A fault found while the
    record was opened (``fault_col``) comes first."""
    parsed = parse(df, value_col)
    why = reason(value_col)
    return parsed.withColumn("reason", F.coalesce(F.col(fault_col), why) if fault_col else why)


ENRICHED_COLUMNS = (
    "event_type", "event_id", "event_ts", "store_id", "product_id", "units", "unit_price",
    "on_hand_qty", "received_qty", "event_date", "revenue", "extra",
)
#: Names that enrichment sets: for every event, and for sales.
SET_FIELDS, SET_FOR_SALES = ("event_date", "ingest_ts"), ("revenue",)


def remainder(is_sale: Column) -> Column:
    """JSON text of the fields beyond the event's own contract, keys in order; NULL if there are none."""
    sale = [*COMMON_EVENT_FIELDS, *TYPE_EVENT_FIELDS["pos_sale"], *SET_FIELDS, *SET_FOR_SALES]
    stock = [*COMMON_EVENT_FIELDS, *TYPE_EVENT_FIELDS["inventory_update"], *SET_FIELDS]
    own = F.when(is_sale, F.array(*map(F.lit, sale))).otherwise(F.array(*map(F.lit, stock)))
    rest = F.map_filter(F.col(PARSED).try_cast("map<string, variant>"), lambda k, v: ~F.array_contains(own, k))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def enrich(valid: DataFrame, with_ingest_ts: bool = False) -> DataFrame:
    """Typed columns of valid records plus event_date, revenue, extra (and ingest_ts).

    event_date is the calendar date written in the event's own offset, not the UTC date of the instant.
    """
    is_sale = _text("event_type") == "pos_sale"
    units = F.when(is_sale, _number("units"))
    price = F.when(is_sale, _number("unit_price"))
    cols = [
        _text("event_type").alias("event_type"),
        _text("event_id").alias("event_id"),
        _text("event_ts").alias("event_ts"),
        _text("store_id").alias("store_id"),
        _text("product_id").alias("product_id"),
        units.alias("units"),
        price.alias("unit_price"),
        F.when(~is_sale, _number("on_hand_qty")).alias("on_hand_qty"),
        F.when(~is_sale, _number("received_qty")).alias("received_qty"),
        written_date(_text("event_ts")).cast("string").alias("event_date"),
        F.when(is_sale, round_half_away(units * price, 2)).alias("revenue"),
        remainder(is_sale).alias("extra"),
    ]
    helpers = set(_helper_columns(valid))
    keep = [c for c in valid.columns if c not in helpers and c != "value"]
    out = valid.select(*keep, *cols)
    return out.withColumn("ingest_ts", F.current_timestamp()) if with_ingest_ts else out


def validate_and_enrich(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Valid records, enriched (rejected ones dropped).

    Valid rows are kept by ``inline`` of a one-element array that is NULL for
    rejected rows (a Generate), not by ``where(reason IS NULL)``: the optimizer
    pushes a Filter below the projections by substituting ``reason``, which
    would repeat the JSON parse once per rule. The parse runs once per record.
    """
    enriched = enrich(with_reason(records, value_col))
    cols = [c for c in enriched.columns if c != "reason"]
    keep = F.when(F.col("reason").isNull(), F.array(F.struct(*cols)))
    return enriched.select(F.inline(keep))


def decoded_base64(data: Column) -> Column:
    """The bytes of base64 text, NULL if it is none. Characters outside the alphabet don't count, nor does
    anything behind the padding."""
    letters = F.regexp_replace(data, "[^A-Za-z0-9+/=]", "")
    payload = F.regexp_extract(letters, "^[A-Za-z0-9+/]*={0,2}", 0)
    return F.when(F.length(payload) % 4 == 0, F.try_to_binary(payload, F.lit("base64")))


def decode_base64_json(data: Column) -> Column:
    """base64 text -> VARIANT; NULL for bad base64 or invalid JSON."""
    return F.try_parse_json(decoded_base64(data).cast("string"))


def opened(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Envelopes opened: ``value`` the payload's text, ``raw`` the payload as it came (the whole record
    where no payload can be told), ``fault`` why it could not be opened."""
    envelope = F.try_parse_json(F.col(value_col))
    data = F.try_variant_get(envelope, "$.kinesis.data", "string")
    found = records.withColumn("_data", data).withColumn("_bytes", decoded_base64(F.col("_data")))
    text = F.try_validate_utf8(F.col("_bytes").cast("string"))
    keep = [c for c in records.columns if c != value_col]
    return found.select(
        *keep, text.alias("value"), F.coalesce("_data", value_col).alias("raw"),
        F.when(F.col("_data").isNull(), F.lit("record has no payload"))
        .when(F.col("_bytes").isNull(), F.lit("payload is not base64"))
        .when(text.isNull(), F.lit("payload is not UTF-8 text")).alias("fault"))
