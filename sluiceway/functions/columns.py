"""Column functions the models are written with. All are built-in Spark expressions, but for JSON
that is rewritten token by token."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _looks_iso(text: Column) -> Column:
    # Spark's timestamp cast also takes "12:00", padded text and a blank before the time.
    # ISO 8601 has a dash after the year and a T before the time, or ends there.
    return (
        (F.length(text) >= 4)
        & F.substring(text, 5, 1).isin("-", "")
        & F.substring(text, 11, 1).isin("T", "")
    )


def try_iso_to_ts(text: Column | str, wall_clock: bool = False) -> Column:
    """ISO 8601 text as a UTC timestamp, NULL where it does not parse.

    ``wall_clock=True`` keeps the written hour and ignores the offset; the default
    converts to the instant. Both agree for UTC text.
    """
    text = _col(text)
    parsed = (
        text.try_cast("timestamp_ntz").cast("timestamp")
        if wall_clock
        else F.try_to_timestamp(text)
    )
    return F.when(_looks_iso(text), parsed)


def iso_to_ts(text: Column | str, wall_clock: bool = False) -> Column:
    """ISO 8601 text as a UTC timestamp; text that does not parse fails the query."""
    text = _col(text)
    problem = F.concat(F.lit("not an ISO 8601 timestamp: "), text)
    return F.coalesce(
        try_iso_to_ts(text, wall_clock),
        F.when(text.isNotNull(), F.raise_error(problem).cast("timestamp")),
    )


def iso_to_date(text: Column | str) -> Column:
    """Date of an ISO 8601 timestamp; text that does not parse fails the query."""
    return F.to_date(iso_to_ts(text))


def try_cast_date(text: Column | str) -> Column:
    """Full ``yyyy-MM-dd`` text as a date, NULL for anything else."""
    text = _col(text)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def trunc_hour(ts: Column | str) -> Column:
    return F.date_trunc("hour", _col(ts))


def trunc_day(ts: Column | str) -> Column:
    return F.date_trunc("day", _col(ts))


def concat_key(*parts: Column | str) -> Column:
    """Parts joined with ``:``; NULL if any part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(":"))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def file_name_from_key(key: Column | str, extension: str = "csv") -> Column:
    """Last path segment if it has the extension, else NULL."""
    return F.nullif(F.regexp_extract(_col(key), rf"([^/]+\.{extension})$", 1), F.lit(""))


def json_label_count(text: Column | str) -> Column:
    """Length of a JSON array; 0 for NULL, bad text and anything that is not an array."""
    return F.coalesce(F.json_array_length(_col(text)), F.lit(0))


def int_flag_to_bool(flag: Column | str) -> Column:
    """True for 1, false for every other value and for NULL."""
    return F.coalesce(_col(flag).cast("int") == 1, F.lit(False))


def count_to_flag(count: Column | str) -> Column:
    return F.coalesce(_col(count) > 0, F.lit(False))


def in_list_ci(text: Column | str, lower_case_values: Sequence[str]) -> Column:
    """Case-insensitive membership; NULL counts as not in the list."""
    return F.coalesce(F.lower(_col(text)).isin(*lower_case_values), F.lit(False))


def below_bands(value: Column | str, bands: Sequence[tuple[float, str]], above: str) -> Column:
    """Name of the first band whose upper bound exceeds the value.

    NULL compares with nothing and so falls to ``above``.
    """
    value = _col(value)
    (bound, name), *rest = bands
    case = F.when(value < bound, name)
    for bound, name in rest:
        case = case.when(value < bound, name)
    return case.otherwise(above)


def relabel(value: Column | str, labels: Mapping[str, str]) -> Column:
    """Mapped label where there is one, else the value itself."""
    value = _col(value)
    case = value
    for code, label in reversed(labels.items()):
        case = F.when(value == code, label).otherwise(case)
    return case


def coalesce_default(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), F.lit(default))


# Runs of quoted strings and other characters up to a separator, anchored at the end of
# the previous match so that separators inside strings are never touched.
_BEFORE_SEPARATOR = r'\G((?:"(?:[^"\\]++|\\.)*+"|[^",:]++)*+)([,:])'


def sorted_json(value: Column | str) -> Column:
    """JSON text of a VARIANT, keys sorted, with a blank after ``,`` and ``:``, in ASCII."""
    return spaced_json(F.to_json(_col(value)))


def spaced_json(text: Column) -> Column:
    return ascii_json(F.regexp_replace(text, _BEFORE_SEPARATOR, "$1$2 "))


def ascii_json(text: Column) -> Column:
    """JSON text with every character beyond ASCII as ``\\uXXXX``, in pairs above U+FFFF."""

    def escaped(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def character(c: Column) -> Column:
        code = F.ascii(c)
        above = code - 0x10000
        pair = F.concat(
            escaped(F.shiftright(above, 10) + 0xD800),
            escaped(above.bitwiseAND(F.lit(0x3FF)) + 0xDC00),
        )
        return F.when(code < 128, c).when(code < 0x10000, escaped(code)).otherwise(pair)

    whole = F.array_join(F.transform(F.split(text, ""), character), "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), whole).otherwise(text)


def nested_to_json(value: Column | str) -> Column:
    """VARIANT to text: arrays and objects as sorted JSON, scalars as plain text."""
    value = _col(value)
    text = F.to_json(value)
    return F.when(F.substring(text, 1, 1).isin("{", "["), sorted_json(value)).otherwise(
        F.variant_get(value, "$", "string")
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used. Spark finds equal
    parts by itself only outside of lambda functions."""
    return F.transform(F.array(value), use)[0]


def nested_text_to_json(text: Column | str) -> Column:
    """JSON text in canonical form, from the tokens of the text itself; NULL for NULL.

    Arrays and objects become sorted JSON, scalars plain text. Integers keep their digits, all
    other numbers become the shortest decimal of the double, with an exponent below 1e-4 and
    from 1e16 on, such as ``1.0``, ``1e-05`` or ``1.5e+20``; beyond the range of a double that
    is ``Infinity``. Numbers may begin with zeros. Text that is no JSON and keys that come twice
    fail the query.

    VARIANT keeps neither ``1.0`` nor long numbers, and expressions that find them in the text
    take six times as long as parsing it in Python, where all but strings go.
    """
    text = _col(text)
    string = _once(
        F.try_parse_json(text),
        lambda value: F.when(
            F.to_json(value).startswith('"'), F.variant_get(value, "$", "string")
        ),
    )
    scalar = ~F.substring(F.ltrim(text), 1, 1).isin("{", "[")
    return F.arrow_udf(_canonical_texts(), "string")(text, F.when(scalar, string))


def nested_member_to_json(row: Column | str, name: str, text: Column | str) -> Column:
    """Member ``name`` of a JSON object, in the form of :func:`nested_text_to_json`.

    ``text`` is the member as ``from_json`` gives it as STRING. That is right for strings and
    booleans; what may be an array, an object or a number is taken from the text of the row.
    """
    text = _col(text)
    unsure = F.substring(text, 1, 1).isin(*"{[-0123456789")
    return F.arrow_udf(_canonical_texts(name), "string")(
        F.when(unsure, _col(row)), F.when(~unsure, text)
    )


def _canonical_texts(member: str | None = None):
    """The function of a task: canonical form of JSON texts, or of a member of theirs, but for
    those that have a string already. Made here, it goes to tasks by value; they import nothing."""

    def texts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        quoted = r'"((?:[^"\\]|\\.)*)"'
        tokens = re.compile(quoted + "|-?[0-9][0-9.eE+-]*")
        marked = re.compile(quoted)
        encode = json.JSONEncoder(sort_keys=True).encode
        sys.set_int_max_str_digits(0)

        # Objects of the text of which a key comes twice.
        repeated = []

        def members(pairs):
            found = dict(pairs)
            if len(found) != len(pairs):
                repeated.append(found)
            return found

        def check(value):
            if any(value is one for one in repeated):
                raise ValueError(f"a key comes twice in JSON: {value}")
            if isinstance(value, (dict, list)):
                for part in value.values() if isinstance(value, dict) else value:
                    check(part)

        def constant(name):
            raise ValueError(f"not JSON: {name}")

        decoder = json.JSONDecoder(
            object_pairs_hook=members, parse_constant=None if member else constant
        )

        def decoded(text):
            """First value of the text, and whether it ends there."""
            text = text.strip(" \t\n\r")
            repeated.clear()
            value, end = decoder.raw_decode(text)
            value = value if member is None else value.get(member)
            if repeated:
                check(value)
            return value, end == len(text)

        def number(digits):
            if re.fullmatch("-?[0-9]+", digits):
                return "0" if digits == "-0" else digits
            return encode(float(digits))

        def lenient(text):
            # Every number as the string "n...", which may begin with zeros, and every string
            # as "s...": all keys get the same first letter, so their order stays.
            def mark(match):
                return f'"n{match[0]}"' if match[1] is None else f'"s{match[1]}"'

            def unmarked(match):
                body = match[1]
                return number(body[1:]) if body[0] == "n" else f'"{body[1:]}"'

            value, _ = decoded(tokens.sub(mark, text))
            if isinstance(value, str):
                return number(value[1:]) if value[0] == "n" else value[1:]
            return marked.sub(unmarked, encode(value))

        def canonical(text):
            try:
                value, whole = decoded(text)
            except json.JSONDecodeError:
                if member is not None:
                    raise
                whole = False
            if not whole and member is None:
                return lenient(text)
            if isinstance(value, str):
                # Half of a surrogate pair cannot be text by itself.
                return value.encode("utf-8", "replace").decode()
            return None if value is None else encode(value)

        for many, strings in batches:
            pairs = zip(many.to_pylist(), strings.to_pylist())
            yield pa.array(
                [
                    string if string is not None or text is None else canonical(text)
                    for text, string in pairs
                ],
                pa.string(),
            )

    return texts
