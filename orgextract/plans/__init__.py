"""orgextract.plans"""
