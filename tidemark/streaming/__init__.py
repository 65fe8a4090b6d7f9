"""The live feed."""
