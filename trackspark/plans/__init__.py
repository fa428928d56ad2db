"""End-to-end plans over the driver's tables."""
