"""Diffraction-frame analytics and corpus preparation as Spark DataFrame operators."""
