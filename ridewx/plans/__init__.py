"""The layer graph (bronze → silver → gold) and the query catalog."""
