"""Complete analyses over the stored tables, and the loads that fill them."""
