"""Payment-risk analytics as Spark DataFrame jobs."""

from riskloom.schema import CARD_PAYMENTS, DEFAULT, TxnColumns

__all__ = ["CARD_PAYMENTS", "DEFAULT", "TxnColumns"]
