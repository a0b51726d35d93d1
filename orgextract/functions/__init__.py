"""orgextract.functions"""
