"""Integration and enrichment of astronomical catalogs as lazy DataFrame plans."""
