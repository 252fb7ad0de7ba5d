"""Scalar column functions.  All are built-in expressions, none is a UDF."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry import settings


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp, whatever the session zone is."""
    ts = _col(ts).cast("timestamp_ntz")
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def normalise_epoch(ts, unit: str = "s") -> Column:
    """Seconds from a source that counts in seconds (``s``) or milliseconds (``ms``)."""
    per_second = {"s": 1, "ms": 1000}[unit]
    return F.floor(_col(ts).cast("bigint") / F.lit(per_second)).cast("bigint")


def epoch_now() -> Column:
    """Whole seconds since 1970 at the start of the query; one value for all its rows."""
    return F.unix_timestamp(F.current_timestamp())


def change_date(epoch, zone: str = "UTC") -> Column:
    """``yyyyMM`` as an int, in an explicit zone."""
    epoch = _col(epoch).cast("bigint")
    if zone == "UTC":
        day = F.date_from_unix_date(F.floor(epoch / 86400).cast("int"))
    else:
        day = F.from_utc_timestamp(F.timestamp_seconds(epoch), zone)
    return (F.year(day) * 100 + F.month(day)).cast("int")


def cooccurrence_similarity(co, count1, count2) -> Column:
    # In double: the product of two large counts does not fit a bigint.
    return _col(co) / F.sqrt(_col(count1).cast("double") * _col(count2).cast("double"))


def dot(a, b) -> Column:
    """Sum of products of two equally long numeric arrays, in double."""
    products = F.zip_with(
        _col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def cosine(a, b) -> Column:
    """Cosine of two dense arrays; null when either norm is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


def log2(n) -> Column:
    return F.log2(_col(n))


def halve_score(score) -> Column:
    """0-10 widget score to 0-5, two decimals, half up."""
    return F.round(_col(score) / 2, 2)


def user_id_from_name(name) -> Column:
    """32-bit polynomial (base 31) string hash over UTF-16 code units."""
    # A code point above U+FFFF counts as its two surrogate units.
    units = F.flatten(
        F.transform(
            # Splitting leaves an empty piece at the end.
            F.filter(F.split(_col(name), ""), lambda ch: ch != ""),
            lambda ch: F.when(
                _code_point(ch) > 0xFFFF,
                F.array(
                    (F.shiftright(_code_point(ch) - 0x10000, 10) + 0xD800),
                    ((_code_point(ch) - 0x10000).bitwiseAND(0x3FF) + 0xDC00),
                ),
            ).otherwise(F.array(_code_point(ch))),
        )
    )
    unsigned = F.aggregate(
        units,
        F.lit(0).cast("bigint"),
        lambda acc, u: F.pmod(acc * 31 + u, F.lit(1 << 32)),
    )
    return (
        F.when(unsigned >= (1 << 31), unsigned - (1 << 32)).otherwise(unsigned).cast("int")
    )


_WORD = 0xFFFFFFFF


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _times(x: Column, factor: int) -> Column:
    # In halves, as the product of two 32-bit numbers doesn't fit in a bigint.
    high = (x * (factor >> 16)).bitwiseAND(0xFFFF)
    return (x * (factor & 0xFFFF) + F.shiftleft(high, 16)).bitwiseAND(_WORD)


def _rotated(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseAND(_WORD).bitwiseOR(F.shiftright(x, 32 - bits))


def _from_hex(text: Column, n_bytes: int) -> Column:
    """Little-endian number of at most ``n_bytes`` bytes in hexadecimal; 0 of none."""
    turned = F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(n_bytes))])
    return F.coalesce(F.conv(turned, 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def _mixed(k: Column) -> Column:
    return _let(_times(k, 0xCC9E2D51), lambda x: _times(_rotated(x, 15), 0x1B873593))


def term_bucket(term, num_features: int) -> Column:
    """Bucket of a term in hashed term features: MurmurHash3 of its UTF-8 with seed 42, as MLlib's
    ``HashingTF`` has it.  (``F.hash`` reads the last bytes of a text in another way.)"""
    text = F.hex(F.encode(_col(term), "UTF-8"))
    blocks = F.regexp_extract_all(text, F.lit(".{8}"), F.lit(0))
    rest = F.substr(text, 8 * F.size(blocks) + 1)
    hashed = F.aggregate(
        F.transform(blocks, lambda b: _mixed(_from_hex(b, 4))),
        F.lit(42).cast("bigint"),
        lambda h, k: (_rotated(h.bitwiseXOR(k), 13) * 5 + 0xE6546B64).bitwiseAND(_WORD),
    )
    hashed = hashed.bitwiseXOR(_mixed(_from_hex(rest, 3))).bitwiseXOR(F.floor(F.length(text) / 2))
    hashed = _let(hashed, lambda h: _times(h.bitwiseXOR(F.shiftright(h, 16)), 0x85EBCA6B))
    hashed = _let(hashed, lambda h: _times(h.bitwiseXOR(F.shiftright(h, 13)), 0xC2B2AE35))
    signed = _let(hashed, lambda h: h.bitwiseXOR(F.shiftright(h, 16)).cast("bigint"))
    signed = _let(signed, lambda h: F.when(h > (_WORD >> 1), h - (1 << 32)).otherwise(h))
    return F.pmod(signed, F.lit(num_features)).cast("int")


def _code_point(ch) -> Column:
    # Four big-endian bytes of UTF-32 read as one hexadecimal number.
    return F.conv(F.hex(F.encode(ch, "UTF-32")), 16, 10).cast("bigint")


def redecode_query(text) -> Column:
    """Text that was read as ISO-8859-1 although its bytes were UTF-8."""
    return F.decode(F.encode(_col(text), "ISO-8859-1"), "UTF-8")


def event_payload(user, product, score, epoch) -> Column:
    return F.concat_ws(
        settings.EVENT_SEPARATOR,
        *[_col(c).cast("string") for c in (user, product, score, epoch)],
    )


def log_line(user, product, score, epoch) -> Column:
    return F.concat(F.lit(settings.LOG_PREFIX), event_payload(user, product, score, epoch))


def normalise_tags(tags) -> Column:
    return F.translate(_col(tags), settings.MULTI_VALUE_SEPARATOR, " ")


def queue_item(product, score) -> Column:
    return F.concat_ws(
        settings.QUEUE_ITEM_SEPARATOR, _col(product).cast("string"), _col(score).cast("string")
    )


def parse_queue_item(item) -> Column:
    parts = F.split(_col(item), settings.QUEUE_ITEM_SEPARATOR)
    return F.struct(
        F.trim(parts[0]).cast("bigint").alias("productId"),
        F.trim(parts[1]).cast("double").alias("score"),
    )
