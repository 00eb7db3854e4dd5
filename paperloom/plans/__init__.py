"""End-to-end plans and the catalogue of runnable queries."""
