"""Part of larder."""
