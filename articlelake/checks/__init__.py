"""The library's operators on the driver's tables, each with an independent SQL answer."""
