from pulseframe.functions.hashing import as_fraction, hash_long, hash_normals
from pulseframe.functions.numeric import clip, log_loss, parse_double, parse_int, safe_ratio, to_fixed
from pulseframe.functions.rules import any_of, bucket, classify, interaction, weighted_deviation
from pulseframe.functions.text import display_number, display_percent, escape_html, iso_millis

__all__ = [
    "any_of", "as_fraction", "bucket", "classify", "clip", "display_number", "display_percent", "escape_html",
    "hash_long", "hash_normals", "interaction", "iso_millis", "log_loss",
    "parse_double", "parse_int", "safe_ratio", "to_fixed", "weighted_deviation",
]
