"""Daily snapshot histories from change-event feeds, and the revenue questions asked of them."""
