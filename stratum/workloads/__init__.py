"""The given test tables shaped as bronze data, and one query per operator with its SQL twin."""
