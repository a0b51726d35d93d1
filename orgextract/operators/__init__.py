"""orgextract.operators"""
