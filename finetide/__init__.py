"""Spark-native preparation of fine-tuning data.

Every operator takes a DataFrame and returns a DataFrame; rows stay on the executors.
"""

from finetide.errors import DataError
from finetide.specs import DatasetSpec, Filters, GenerationSpec, SplitSpec

__all__ = ["DataError", "DatasetSpec", "Filters", "GenerationSpec", "SplitSpec"]
