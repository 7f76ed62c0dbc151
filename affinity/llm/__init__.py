"""Training-data operators: de-duplication, language identification, sharding, archives,
decontamination, licence scans, packing and URL filters.

Nothing else in the package imports this subpackage; `contract.py` holds its registered
queries and oracle SQL.
"""
