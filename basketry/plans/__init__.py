"""Mining plans: transaction extraction and the five strategies, which all
return the same levels."""

from basketry.plans.levels import Level, LevelMiner, apriori, itemsets_as_text, prepare
from basketry.plans.pcy import PCYMiner, pcy
from basketry.plans.scan import ScanMiner, apriori_scan
from basketry.plans.son import SONMiner, hash_chunks, son
from basketry.plans.toivonen import Toivonen, ToivonenResult, sample_threshold, toivonen
from basketry.plans.transactions import Baskets, extract_transactions, to_transactions

__all__ = [
    "Level", "LevelMiner", "apriori", "itemsets_as_text", "prepare", "PCYMiner", "pcy", "ScanMiner",
    "apriori_scan", "SONMiner", "hash_chunks", "son", "Toivonen", "ToivonenResult", "sample_threshold",
    "toivonen", "Baskets", "extract_transactions", "to_transactions",
]
