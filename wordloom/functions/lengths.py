"""Field length as it is kept for scoring: one lossy byte."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lengths below 40 are exact, longer ones keep four significant
# bits above an offset of 24.
EXACT_BELOW = 40
OFFSET = 24
KEPT_BITS = 4


def quantize_length(length: Column) -> Column:
    above = (length - OFFSET).cast("bigint")
    shift = (F.length(F.bin(above)) - KEPT_BITS).cast("int")
    kept = F.call_function("shiftleft", F.call_function("shiftright", above, shift), shift)
    return F.when(length < EXACT_BELOW, length.cast("bigint")).otherwise(kept + OFFSET).cast("int")
