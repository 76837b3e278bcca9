"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from tackroom.functions.jsonline import (
    is_blank, strict_parse, record_id, id_identity, js_truthy_id,
)
from tackroom.functions.columns import (
    falsy_to_null, first_elem, prize_total, round6,
)
from tackroom.functions.fold import fold_prizes

__all__ = [
    "is_blank", "strict_parse", "record_id", "id_identity", "js_truthy_id",
    "falsy_to_null", "first_elem", "prize_total", "round6", "fold_prizes",
]
