"""basketlab.plans"""
