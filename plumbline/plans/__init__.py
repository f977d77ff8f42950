"""plumbline.plans"""
