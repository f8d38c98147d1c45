"""End-to-end plans (the three analysis steps) and the query catalog."""
