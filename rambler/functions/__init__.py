"""Column expressions: JVM-side, codegen-friendly, no Python UDFs."""

from rambler.functions.phone import normalize_phone, PHONE_PATTERN  # noqa: F401
from rambler.functions.vectors import dot, norm, cosine  # noqa: F401
from rambler.functions.draws import draw, DRAW_SCALE  # noqa: F401
