"""shelfsense: inventory-risk analytics expressed as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``); parameters live in :class:`shelfsense.config.RiskParams`.
"""

from shelfsense.config import RiskParams, LABELS, CLASS_NAMES

__all__ = ["RiskParams", "LABELS", "CLASS_NAMES"]
