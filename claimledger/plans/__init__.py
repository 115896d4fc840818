"""The jobs: encounter balances, the charge fact, and the warehouse load."""
