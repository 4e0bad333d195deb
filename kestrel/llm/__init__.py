"""Training-data pipeline operators (quality, near-duplicates, secrets, mixing,
tokenisation, archives, sharding, exact search). Nothing else in the library
imports this subpackage; ``queries.py`` holds the registered queries."""
