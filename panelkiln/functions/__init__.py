"""Part of panelkiln."""
