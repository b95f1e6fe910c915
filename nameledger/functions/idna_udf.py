"""The Arrow UDFs for internationalised names (UTS-46 with STD3 rules, lookup profile)."""

import sys
import unicodedata

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:
    import idna as _idna
except ImportError:  # pragma: no cover - the package is optional
    _idna = None

HAS_IDNA = _idna is not None

# Executors get these few functions with the task, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _encode_label(label: str) -> str | None:
    """One UTS-46 mapped label to its ASCII form, or None when the label is not valid."""
    text = label
    if label.startswith("xn--"):
        text = label[4:].encode("ascii").decode("punycode")
        if text.isascii() or _idna.uts46_remap(text, std3_rules=True) != text:
            return None
    elif len(label) > 4 and label[2:4] == "--":
        return None
    if text.startswith("-") or text.endswith("-"):
        return None
    if text.isascii():
        return text
    _idna.check_initial_combiner(text)
    for pos, char in enumerate(text):
        if char in "\u200c\u200d" and not _idna.core.valid_contextj(text, pos):
            return None
    return "xn--" + text.encode("punycode").decode("ascii")


def _encode_name(name: str | None) -> str | None:
    if name is None:
        return None
    try:
        labels = _idna.uts46_remap(name, std3_rules=True, transitional=False).split(".")
        coded = [_encode_label(label) if label else "" for label in labels]
        if None in coded:
            return None
        unicode_labels = [
            label[4:].encode("ascii").decode("punycode") if label.startswith("xn--") else label
            for label in coded
        ]
        if any(_is_rtl(label) for label in unicode_labels):
            for label in filter(None, unicode_labels):
                _idna.check_bidi(label, check_ltr=True)
        return ".".join(coded)
    except (UnicodeError, ValueError):
        return None


def _is_rtl(label: str) -> bool:
    return any(unicodedata.bidirectional(ch) in ("R", "AL", "AN") for ch in label)


@F.arrow_udf(T.StringType())
def idna_ascii(names: pa.Array) -> pa.Array:
    if names.null_count == len(names):
        return names
    return pa.array([_encode_name(n) for n in names.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def idna_ascii_array(rows: pa.Array) -> pa.Array:
    """Null for rows without a name. Send them as empty lists: a null list makes Spark go over all nulls before it again."""
    if not len(rows.flatten()):
        return pa.nulls(len(rows), pa.list_(pa.string()))
    coded = [[_encode_name(n) for n in row] if row else None for row in rows.to_pylist()]
    return pa.array(coded, pa.list_(pa.string()))


