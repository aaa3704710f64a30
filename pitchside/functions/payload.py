"""Per-payload checks of the API envelope ``{"errors": ..., "results": n, "response": [...]}``.

A payload is bad when its ``errors`` member is truthy: the API reports failures with HTTP 200 and a
populated ``errors`` object, and ``[]`` on success. Text that is not a JSON object cannot be read as
an envelope at all and is bad too.

One ``from_json`` pass reads the whole envelope check: ``errors`` as a VARIANT, which keeps its JSON
type (the string ``"false"`` is an error text, the literal ``false`` is not), ``results`` as text, and
the malformed-record column, which is set for text that is not a JSON object. Text after a complete
object is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CORRUPT = "_corrupt_record"
ENVELOPE_DDL = f"errors VARIANT, results STRING, {_CORRUPT} STRING"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def payload_envelope(payload: str | Column) -> Column:
    """The envelope struct ``(errors, results, _corrupt_record)`` from one JSON pass."""
    return F.from_json(_col(payload), ENVELOPE_DDL, {"columnNameOfCorruptRecord": _CORRUPT})


def envelope_is_ok(env: Column) -> Column:
    """TRUE iff the envelope is a JSON object whose ``errors`` member is absent or falsy."""
    kind, text = F.schema_of_variant(env["errors"]), envelope_error_text(env)
    is_object = env.isNotNull() & env[_CORRUPT].isNull()
    falsy = (env["errors"].isNull() | (kind == "VOID") | text.isNull()
             | ((kind == "STRING") & (text == ""))
             | ((kind == "BOOLEAN") & (text == "false"))
             | (kind.startswith("ARRAY") & (text == "[]"))
             | (kind.startswith("OBJECT") & (text == "{}"))
             | ((kind != "STRING") & (text.try_cast("double") == F.lit(0.0))))
    return F.coalesce(is_object & falsy, F.lit(False))


def envelope_error_text(env: Column) -> Column:
    return env["errors"].cast("string")


def envelope_result_count(env: Column) -> Column:
    return env["results"].try_cast("int")


#: Bytes up to which a text is counted by ``text_chars`` through a copy of twice its size.
_COPIED = 1 << 20


def text_chars(text: str | Column) -> Column:
    """``length(text)``. Spark finds the characters of a text one after the other; that a text has as many
    UTF-16 units as bytes, and with that as many characters, is seen in a fraction of the time."""
    c = _col(text)
    n = F.octet_length(c)
    return F.when((n <= _COPIED) & (F.octet_length(F.encode(c, "UTF-16LE")) == n * 2), n
                  ).otherwise(F.length(c))


def payload_text(payload: Column, is_text: bool = True) -> Column:
    """The body as stored in the log: text stays untouched; a body already parsed into a struct
    or map (e.g. read with a JSON reader) is serialised back with ``to_json``."""
    return payload if is_text else F.to_json(payload, {"ignoreNullFields": "false"})


def endpoint_path(endpoint: str | Column) -> Column:
    """Queue endpoint name -> API path (NULL for names outside the map)."""
    from pitchside.sources.schemas import ENDPOINT_PATHS
    pairs = [F.lit(x) for kv in ENDPOINT_PATHS.items() for x in kv]
    return F.create_map(*pairs)[_col(endpoint)]


def payload_is_ok(payload: str | Column) -> Column:
    return envelope_is_ok(payload_envelope(payload))


def payload_error_text(payload: str | Column) -> Column:
    """The ``errors`` member as text; NULL when absent or JSON null."""
    return envelope_error_text(payload_envelope(payload))


def payload_result_count(payload: str | Column) -> Column:
    """The envelope's ``results`` count as INT (NULL when absent or not a number)."""
    return envelope_result_count(payload_envelope(payload))
