"""Part of groundmill; see the package README."""
