"""Part of quadrille; see README.md."""
